"""Registered corpus queries: against SQL where there is some, and the pipeline's stages."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from headway.llm import decontaminate, near_join, queries
from headway.session import stage
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_all_are_registered():
    numbers = {name.split("_")[0] for name in queries.queries()}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert set(queries.oracle_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_oracle(spark, con, name):
    names, rows = oracle.from_spark(queries.queries()[name](spark, SF))
    expected_names, expected = oracle.from_duckdb(con, queries.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_other_queries_give_every_document(spark, name):
    rows = queries.queries()[name](spark, SF)
    assert {r.doc_id for r in rows.select("doc_id").collect()} == set(range(200))


def test_the_pipeline_stage_by_stage(spark):
    """Each stage works on what the last one kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for name, apply in corpus_pipeline.STAGES:
        before, docs = docs, stage(apply(spark, docs, SF), "stage")
        counts.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and docs.dtypes == before.dtypes
        if name == "line dedup":
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "n-gram Jaccard join":
            assert near_join.similar_documents(docs).where("n_links > 0").count() == 0
        if name == "benchmark decontamination":
            items = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.find_contamination(docs, items).where("contaminated").count() == 0
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert counts[0] > counts[1] == counts[2] > counts[3] > counts[4]
    assert {r.doc_id for r in docs.select("doc_id").collect()} == kept

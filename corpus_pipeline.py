"""A corpus pipeline: each stage is one of the operators, applied to what the last one kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of ``docs``; the last
returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import own, stage
from headway.llm.decontaminate import drop_contaminated
from headway.llm.line_dedup import drop_shared_lines
from headway.llm.near_join import keep_one_per_class
from headway.llm.packing import pack_sequences
from headway.llm.toxicity import keep_ordinary


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the labels teach outside their held-out fold."""
    return keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines shared by ten documents or more go; every document stays, with its new length."""
    kept = drop_shared_lines(docs)
    if "n_chars" in docs.columns:
        changed = F.when(F.col(own(docs, "n_dropped")) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        kept = kept.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return keep_one_per_class(docs)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token sequences."""
    return pack_sequences(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", reject_contaminated),
    ("best-fit packing", pack),
]

#: Scores of a trained model decide the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

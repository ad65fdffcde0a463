from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions

from headway.llm import line_dedup as op
from headway.llm.common import lower_ascii
from tests.llm.frames import DOCS, corpus, documents

LOW = {c: c + 32 for c in range(65, 91)}


def plain(rows: list[tuple], least: int) -> dict:
    """By brute force: (id, text) to kept text, lines and dropped lines."""
    key = lambda line: re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line).translate(LOW)
    holders = defaultdict(set)
    for row in rows:
        for line in (row[1] or "").split("\n"):
            holders[key(line)].add(row)
    out = {}
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or len(holders[key(x)]) < least]
        out[row] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def check(spark, ids, texts, least):
    docs = documents(spark, texts, ids)
    got = op.drop_shared_lines(docs, least)
    assert got.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    expected = plain(list(zip(ids, texts, strict=True)), least)
    place = {f"r{k}": (i, t) for k, (i, t) in enumerate(zip(ids, texts, strict=True))}
    rows = got.collect()
    assert sorted(r.rid for r in rows) == sorted(place)
    for r in rows:
        text, n, dropped = expected[place[r.rid]]
        assert (r.text or "", r["__n_lines"], r["__n_dropped"]) == (text, n, dropped)


def test_lines_of_odd_corpora(spark):
    ids, texts = corpus()
    shared = ["  Shared Line", "shared line\t", "SHARED LINE", "\x0bshared line\r", "x\nshared line\ny"]
    check(spark, [*ids, *range(900, 905)], [*texts, *shared], 5)
    check(spark, [*ids, *range(900, 905)], [*texts, *shared], 6)


@pytest.mark.parametrize("tasks", [1, 7, 40])
def test_a_hot_line_in_any_number_of_partitions(spark, tasks, monkeypatch):
    rng = np.random.default_rng(tasks)
    texts = ["\n".join([f"line {k}" for k in rng.integers(0, 40, 8)] + ["hot"] * (i % 3)) for i in range(300)]
    monkeypatch.setattr(op, "KEYS_PER_TASK", 3000 // tasks)
    check(spark, list(range(300)), texts, 60)


def test_no_rows(spark):
    assert op.drop_shared_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_documents_come_back_few_at_a_time(monkeypatch):
    """A batch of many texts is taken apart and handed back in slices; none is lost."""
    import pyarrow as pa

    monkeypatch.setattr(op, "ROWS_AT_ONCE", 3)
    texts = [None if k == 4 else f"a{k}\nb" for k in range(8)]
    batch = pa.RecordBatch.from_pydict({"id": list(range(8)), "text": pa.array(texts, pa.string()),
                                        "keep": pa.array([None] * 8, pa.binary())})
    out = list(op._unpack("keep", "n")([batch]))
    assert [b.num_rows for b in out] == [3, 3, 2]
    assert pa.Table.from_batches(out).column("text").to_pylist() == texts


def test_lower_ascii_leaves_other_letters(spark):
    texts = ["ABC xyz", "\u00c4B\u00c9", "\u0130I", "K\u212a", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(lower_ascii(functions.col("t")).alias("l"))
    assert [r["l"] for r in df.collect()] == ["abc xyz", "\u00c4b\u00c9", "\u0130i", "k\u212a", "", None]
    assert "lower(" in df._jdf.queryExecution().optimizedPlan().toString()

from __future__ import annotations

import re

import numpy as np
import pytest

from headway.llm import passages as op
from tests.llm.frames import DOCS, corpus, documents, sentence

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute_force(rows, length: int):
    """(doc_id, text, n_words, n_removed) of each row."""
    words = [[w for w in BLANK.split(t or "") if w] for _, t in rows]
    key = [-(2**63) if i is None else i for i, _ in rows]
    low: dict[tuple, int] = {}
    for k, w in zip(key, words, strict=True):
        for p in range(len(w) - length + 1):
            at = tuple(w[p : p + length])
            low[at] = min(low.get(at, k), k)
    out = []
    for (i, text), k, w in zip(rows, key, words, strict=True):
        gone = set()
        for p in range(len(w) - length + 1):
            if low[tuple(w[p : p + length])] < k:
                gone.update(range(p, p + length))
        kept = " ".join([x for p, x in enumerate(w) if p not in gone]) if gone else text
        out.append((i, kept, len(w), len(gone)))
    return sorted(out, key=str)


def result(df, length):
    out = op.drop_repeated_passages(df, length)
    return sorted(map(tuple, out.select("doc_id", "text", "__n_words", "__n_removed").collect()), key=str)


def passages(seed: int):
    """The common cases, plus passages that several documents share in different places."""
    ids, texts = corpus(seed)
    rng = np.random.default_rng(seed)
    shared = [sentence(rng, int(n)) for n in (20, 50, 51, 70, 120)]
    made = []
    for k in range(60):
        parts = [sentence(rng, int(rng.integers(0, 40))), shared[k % 5], sentence(rng, int(rng.integers(0, 40)))]
        if k % 7 == 0:
            parts.append(shared[(k + 1) % 5].replace(" ", "\t\n", 3))
        made.append(" ".join(parts))
    made += [made[3], made[4] + " tail", "same " * 130, "same " * 90, "same " * 49]
    order = rng.permutation(len(made)) + 1000
    return [*zip(ids, texts, strict=True), *zip(order.tolist(), made, strict=True), (1000, None), (1000, made[0])]


@pytest.mark.parametrize(("length", "seed"), [(50, 0), (8, 1), (1, 2), (27, 3), (200, 4)])
def test_as_by_brute_force(spark, length, seed):
    rows = passages(seed)
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert result(df, length) == brute_force(rows, length)


def test_a_passage_in_most_documents_fills_many_partitions(spark):
    """Runs that go on over several range partitions lose no row."""
    rng = np.random.default_rng(5)
    common = sentence(rng, 52)
    rows = [(k, f"{sentence(rng, 5)} {common} {sentence(rng, 3)}") for k in range(400)]
    rows += [(1000 + k, common) for k in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        got = result(documents(spark, [t for _, t in rows], [i for i, _ in rows]), 50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_force(rows, 50)


def test_very_long_texts(spark):
    rng = np.random.default_rng(6)
    long = sentence(rng, 200_000, 5000)
    rows = [(1, long), (2, "x " * 60 + long[100_000:300_000]), (3, "y" * 500_000), (4, "y" * 500_000)]
    got = result(documents(spark, [t for _, t in rows], [i for i, _ in rows]), 50)
    assert [r[2:] for r in got] == [r[2:] for r in brute_force(rows, 50)]
    assert got == brute_force(rows, 50)


def test_levels_double():
    for full in range(1, 300):
        sizes = op.lengths(full)
        assert sizes[-1] == full and sizes[0] <= op.FIRST_LENGTH
        assert all(a < b <= 2 * a for a, b in zip(sizes, sizes[1:], strict=False))


def test_no_rows(spark):
    out = op.drop_repeated_passages(spark.createDataFrame([], DOCS))
    assert out.collect() == [] and out.columns[:2] == ["doc_id", "text"]

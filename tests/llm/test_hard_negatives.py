from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import hard_negatives as op

VECTORS = "vec_id long, embedding array<double>, label int, win string, codes string"


def brute_force(rows, every: int, scale: int = 256):
    usable = [
        (i, r[0], [math.floor(scale * x) for x in r[1]], r[2]) for i, r in enumerate(rows)
        if r[2] is not None and r[1] is not None
        and all(x is not None and math.isfinite(x) and abs(x * scale) < 2**54 for x in r[1])
    ]
    out = []
    for i, a, v, label in usable:
        if a is None or a % every:
            continue
        scored = sorted(
            (-s, -(2**63) if b is None else b, j, b, other == label)
            for j, b, w, other in usable if i != j and len(v) == len(w)
            if abs(s := sum(x * y for x, y in zip(v, w, strict=True))) < 2**63
        )
        for p, _, _, pid, _ in [s for s in scored if s[4]][:5]:
            chosen = [n for n in scored if not n[4] and -30 * p <= -100 * n[0] <= -90 * p][:10]
            out += [(a, pid, k, n[3], -p, -n[0]) for k, n in enumerate(chosen, 1)]
    return out


@pytest.mark.parametrize(("rows", "queries"), [(4096, 1024), (13, 3)])
def test_as_by_brute_force(spark, rows, queries, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ROWS", rows)
    monkeypatch.setattr(op, "BLOCK_QUERIES", queries)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 12))
    made = [(centres[k % 4] * rng.choice([0.2, 1, 1, 2]) + rng.normal(size=12) * 0.6).tolist() for k in range(150)]
    table = [(k, v, int(rng.integers(0, 3))) for k, v in enumerate(made)]
    table += [(k, table[10][1], 1) for k in (150, 150, 10)]  # ties, repeated rows
    table += [(200, None, 1), (201, [math.nan] * 12, 1), (202, [math.inf] + [0.0] * 11, 1), (203, [None] * 12, 1),
              (210, [0.0] * 12, 1), (211, [], 1), (220, [], 2), (230, made[0][:5], 1), (231, made[1][:5], 2),
              (240, made[2], None), (None, made[3], 0), (None, made[3], 2), (250, [-x for x in made[5]], 9)]
    df = spark.createDataFrame([(*r, "w", "c") for r in table], VECTORS)
    got = op.mine_hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute_force(table, 10)
    assert len(expected) > 300
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_large_components_score_exactly(spark):
    rng = np.random.default_rng(2)
    table = [(k, (rng.normal(size=4) * 2.0 ** rng.integers(10, 24)).tolist(), k % 2) for k in range(40)]
    table += [(100, [1e200] * 4, 0), (101, [2.0**45] * 4, 1)]
    df = spark.createDataFrame([(*r, "w", "c") for r in table], VECTORS)
    got = op.mine_hard_negatives(df, F.col("vec_id") % 4 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(table, 4))


@pytest.mark.parametrize("share", [0.2, 0.6, 0.95])
def test_candidates_lose_no_pair_and_leave_dimensions_out(share):
    rng = np.random.default_rng(3)
    decay = np.exp(-np.arange(40) / 6)
    rows = np.floor(rng.normal(size=(300, 40)) * decay * 200)
    queries = np.floor(rng.normal(size=(20, 40)) * decay * 200)
    score = queries @ rows.T
    thresholds = np.quantile(score, share + 0.04, axis=1)
    i, j = op.candidates(queries, rows, thresholds)
    reached = {(a, b) for a, b in zip(*np.nonzero(score >= thresholds[:, None]), strict=True)}
    assert reached <= set(zip(i.tolist(), j.tolist(), strict=True))
    held = op.indexed_dims(op._left_norms(rows), op._left_norms(queries), float(thresholds.min()))
    if share > 0.9:
        assert held.mean() < 40 and len(i) < score.size


def test_no_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert op.mine_hard_negatives(empty, F.col("vec_id") % 10 == 0).collect() == []

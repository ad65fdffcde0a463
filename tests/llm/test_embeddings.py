from __future__ import annotations

import math

import numpy as np
import pytest

from headway.llm import embeddings as op

VECTORS = "vec_id long, embedding array<float>, label int, cls string, n string"


@pytest.mark.parametrize("block", [1024, 7])
def test_links_as_by_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", block)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 16))
    made = [(centres[k % 6] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.5])).tolist() for k in range(60)]
    rows = [(k, v, k % 2 if k % 7 else None) for k, v in enumerate(made)]
    rows += [(100, rows[1][1], 1), (99, rows[1][1], 1), (99, rows[1][1], 1), (101, None, 1), (102, [0.0] * 16, 1),
             (103, [math.nan] * 16, 1), (104, [math.inf] + [0.0] * 15, 1), (105, [], 1), (106, [None] * 16, 1),
             (107, rows[1][1][:4], 1), (None, rows[3][1], 1), (108, [x * 1e-3 for x in rows[5][1]], 1)]
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    vec = [np.array(r[1], np.float32).astype(float) if ok(r[1]) else None for r in rows]

    def linked(i, j):
        a, b = vec[i], vec[j]
        if a is None or b is None or len(a) != len(b) or rows[i][2] is None or rows[i][2] != rows[j][2]:
            return False
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.93

    n = len(rows)
    links = [[j for j in range(n) if j != i and linked(i, j)] for i in range(n)]
    low = -(2**63)
    group = [low if r[0] is None else r[0] for r in rows]
    for _ in range(n):
        group = [min([group[i], *[group[j] for j in links[i]]]) for i in range(n)]
    name = lambda g: None if g == low else g
    expected = [(r[0], len(k), name(g), r[0] == name(g)) for r, k, g in zip(rows, links, group, strict=True)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], VECTORS)
    got = op.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("dims", [3, 64, 1500])
def test_bounds_hold_and_lose_no_pair(dims):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(40, dims)) * rng.choice([1e-6, 1, 1e6], (40, 1))
    base[5:20] = base[0] + rng.normal(size=(15, dims)) * np.abs(base[0]).mean() * 0.4
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    codes, scale, size, error = op.quantise(unit)
    exact, near = unit @ unit.T, op._products(codes, codes) * (scale[:, None] * scale)
    bound = size[:, None] * error + error[:, None] * (size + error)
    assert (np.abs(exact - near) <= bound + 1e-12).all()
    i, j = op.close_pairs(base, base, 0.93, same=True)
    want = [(a, b) for a in range(40) for b in range(a + 1, 40) if exact[a, b] >= 0.93]
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_no_rows(spark):
    assert op.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []

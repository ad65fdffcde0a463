from __future__ import annotations

import numpy as np
import pytest

from headway.llm import common


def brute_force(edges):
    low = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(low)):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    return sorted(low.items())


@pytest.mark.parametrize("share", [20_000, 7])
def test_components_as_by_brute_force(spark, share, monkeypatch):
    monkeypatch.setattr(common, "EDGES_PER_TASK", share)
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 120, (70, 2)).tolist()
    chain = [(k, k + 1) for k in range(1000, 1040)] + [(3000 - k, 2000 + k) for k in range(0, 400, 37)]
    star = [(5000, x) for x in range(4970, 5000)] + [(5001, 5001), (-5, -(2**63))]
    edges = [*map(tuple, pairs), *chain, *star, *chain]
    got = common.connected_components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert sorted(map(tuple, got)) == brute_force(edges)


def test_no_edges(spark):
    assert common.connected_components(spark.createDataFrame([], "a long, b long"), "test").collect() == []

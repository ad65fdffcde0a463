"""The tree queries fit the published job; boosting is exact, seeded, and stops early."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.models import boosting as B
from headway.models import regressor as M
from headway.plans import queries as registered

SF = "/root/testdata/sf0.001"
SMALL = B.TrainParams(max_depth=3, eta=0.5, rounds=6)


class Caught(Exception):
    pass


def rows(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.integers(0, 24, n), rng.integers(0, 500, n), rng.normal(size=n), np.zeros(n)]
    y = x[:, 1] * 0.5 + np.where(x[:, 0] > 12, 90, 0) + rng.integers(-20, 20, n)
    made = [(v.tolist(), float(round(t)), bool(k % 5 == 0)) for k, (v, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(made, "features array<double>, y double, held boolean")


def plain(model):
    trees = [(t.feature.tolist(), t.cut.tolist(), t.value.tolist()) for t in model.trees]
    return model.base, [c.tolist() for c in model.cuts], trees, model.errors


@pytest.mark.parametrize("name", ["gbt_predictions", "gbt_scores"])
def test_tree_queries_fit_with_published_settings(spark, monkeypatch, name):
    def fit(df, params):
        raise Caught(params)

    monkeypatch.setattr(M, "boost", fit)
    monkeypatch.setattr(registered, "_models", {})
    with pytest.raises(Caught) as seen:
        registered.queries()[name](spark, SF)
    params = seen.value.args[0]
    assert params == M.TrainParams()
    assert (params.max_depth, params.rounds, params.early_stopping) == (8, 800, 50)


def test_one_round_is_the_best_split_by_brute_force(spark):
    df = rows(spark, 200)
    params = replace(SMALL, max_depth=1, rounds=1, subsample=1.0, colsample=1.0)
    model = B.boost(df, params)
    train = [(r["features"], r["y"]) for r in df.where("NOT held").collect()]
    y = np.array([t for _, t in train])
    base = np.sort(y)[int(np.ceil(len(y) / 2)) - 1]
    best = (0.0, None)
    for f in range(4):
        x = np.array([v[f] for v, _ in train])
        for c in model.cuts[f]:
            left, sign = x <= c, np.sign(y - base)
            if min(left.sum(), (~left).sum()) < params.min_child:
                continue
            gain = sum(sign[k].sum() ** 2 / (k.sum() + 1) for k in (left, ~left)) - sign.sum() ** 2 / (len(y) + 1)
            best = max(best, (gain, (-f, -c)))
    f, c = (-k for k in best[1])
    assert model.base == base
    assert (model.trees[0].feature[1], model.cuts[f][model.trees[0].cut[1]]) == (f, c)
    x = np.array([v[f] for v, _ in train])
    assert model.trees[0].value[2:].tolist() == [
        np.quantile((y - base)[k], 0.5, method="inverted_cdf") for k in (x <= c, x > c)
    ]


def test_levels_and_subtrees_grow_the_same_tree(spark, monkeypatch):
    """Nodes split by summed histograms equal nodes grown by one task."""
    df, models = rows(spark), []
    for bound in (10**6, 0, 100):
        monkeypatch.setattr(B, "SUBTREE_ROWS", bound)
        models.append(B.boost(df, replace(SMALL, rounds=1)))
    one, *others = (m.trees[0] for m in models)
    for other in others:
        assert one.feature.tolist() == other.feature.tolist() and one.cut.tolist() == other.cut.tolist()
        assert one.value.tolist() == other.value.tolist()


def test_rows_travel_in_blocks(spark, monkeypatch):
    """A round moves arrays of many rows, never a row at a time; NULL ``held`` is in neither part."""
    seen, grow = [], B.grow_tree

    def grown(state, *rest):
        seen.append((state.count(), state.agg(F.sum("n_held")).first()[0]))
        return grow(state, *rest)

    monkeypatch.setattr(B, "grow_tree", grown)
    df = rows(spark).coalesce(2)
    more = df.limit(30).withColumn("held", F.lit(None).cast("boolean"))
    model = B.boost(df.union(more), replace(SMALL, rounds=2))
    assert len(seen) == 2 and all(blocks <= 4 and held == 120 for blocks, held in seen)
    assert plain(model)[2] == plain(B.boost(df, replace(SMALL, rounds=2)))[2]


def test_the_same_rows_give_the_same_model(spark):
    df = rows(spark)
    assert plain(B.boost(df, SMALL)) == plain(B.boost(df.orderBy("y").repartition(13), SMALL))
    assert plain(B.boost(df, SMALL))[2] != plain(B.boost(df, replace(SMALL, seed=1)))[2]


def test_boosting_stops_and_keeps_the_best_rounds(spark, monkeypatch):
    monkeypatch.setattr(B, "STAGE_EVERY", 3)
    df = rows(spark)
    model = B.boost(df, replace(SMALL, rounds=40, early_stopping=4))
    best = int(np.argmin(model.errors))
    assert len(model.trees) == best and (len(model.errors) in (41, best + 5))
    assert model.errors[best] < 0.3 * model.errors[0]
    held = df.where("held").collect()
    guess = model.predict(np.array([r["features"] for r in held]))
    assert np.abs(guess - [r["y"] for r in held]).mean() == pytest.approx(model.errors[best], abs=1e-6)
    useless = B.boost(df.withColumn("y", F.when(F.col("held"), -1e6).otherwise(F.col("y"))), replace(SMALL, early_stopping=3))
    assert len(useless.errors) >= 4


def test_tables_without_training_rows(spark):
    df = rows(spark, 20)
    assert B.boost(df.where("false"), SMALL).predict(np.zeros((0, 4))).tolist() == []
    assert B.boost(df.where("held"), SMALL).predict(np.zeros((2, 4))).tolist() == [0.0, 0.0]
    alone = B.boost(df.where("NOT held").limit(1), SMALL)
    assert alone.predict(np.zeros((1, 4))).tolist() == [alone.base]

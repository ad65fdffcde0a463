from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.operators.ranges import (
    discrete_quantiles,
    interpolated_quantile,
    ordered_context,
    value_counts,
    with_group_values,
)


def sample(spark, n=400):
    draw = random.Random(5)
    rows = [
        (draw.choice(["a", "a", "a", "b", None]), draw.choice([None, *range(60)]), i,
         draw.choice([None, draw.randint(-50, 50)]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k string, seq int, id int, v int")


@pytest.mark.parametrize("size", [None, 1, 7, 1000])
def test_cut_groups_give_the_plain_windows_values(spark, size):
    df = sample(spark)
    w = Window.partitionBy("k").orderBy("seq", "id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    expected = df.withColumns(
        {"prev": F.lag("v").over(w), "run_sum": F.sum("v").over(before),
         "run_n": F.count("v").over(before)}
    )
    got = ordered_context(
        df, ["k"], ["seq", "id"], size and F.floor(F.col("seq") / size), {"prev": "v"}, {"run": "v"},
    )
    assert sorted(got.columns) == sorted(expected.columns)
    key = lambda r: r["id"]
    assert sorted(got.select(*expected.columns).collect(), key=key) == sorted(
        expected.collect(), key=key
    )


def test_group_values_reach_null_groups(spark):
    df = sample(spark)
    got = with_group_values(df, ["k"], F.count(F.lit(1)).alias("n"))
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    assert all(r["n"] == counts[r["k"]] for r in got.collect())


def test_discrete_quantiles_match_percentile_approx(spark):
    df = sample(spark)
    got = discrete_quantiles(value_counts(df, ["k"], "v"), ["k"], "v", {"p50": 0.5, "p90": 0.9})
    expected = df.where("v IS NOT NULL").groupBy("k").agg(
        F.percentile_approx("v", 0.5).alias("p50"), F.percentile_approx("v", 0.9).alias("p90"),
        F.count("v").alias("total"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_interpolated_quantile_matches_numpy(spark, n):
    draw = random.Random(n)
    values = [draw.choice([draw.random() * 5, 2.0, draw.gauss(100, 40)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = interpolated_quantile(df, [], "v", 0.9, "p90").first()["p90"]
    assert got == pytest.approx(float(np.quantile(values, 0.9)))


def test_interpolated_quantile_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, v double")
    got = {r["k"]: r["q"] for r in interpolated_quantile(df, ["k"], "v", 0.5, "q").collect()}
    assert got == {"a": 1.5, "b": 5.0}

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators import backtest as B
from headway.operators import quality as Q

SILVER = "service_date date, trip_id string, stop_id string, observed_delay_sec int"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def rules(df, **kw):
    return {r["rule"]: r for r in Q.dq_rules(df, **kw).collect()}


def test_empty_day_fails_all_but_the_bounds(spark):
    got = rules(spark.createDataFrame([], SILVER))
    assert len(got) == 5
    assert {n for n, r in got.items() if r["passed"]} == {"delay_within_bounds"}


def test_each_rule_can_fail_alone(spark):
    ok = [(D1, "t", f"s{i}", 10) for i in range(10)]
    failing = lambda rows, **kw: {
        n for n, r in rules(spark.createDataFrame(rows, SILVER), **kw).items() if not r["passed"]}
    limits = dict(min_rows=10)
    assert failing(ok, **limits) == set()
    assert failing(ok, min_rows=11) == {"row_count_minimum"}
    assert failing(ok + [(D1, "t", "s0", 10)], **limits) == {"key_uniqueness"}
    assert failing([(d, t, s, None if i < 2 else v) for i, (d, t, s, v) in enumerate(ok)],
                   **limits) == {"label_completeness"}
    assert failing(ok + [(D1, "t", "x", 7201)], **limits) == {"delay_within_bounds"}
    assert "trip_id_completeness" in failing(ok + [(D1, None, "x", 1)], **limits)
    got = rules(spark.createDataFrame(ok, SILVER), **limits)
    assert (got["delay_within_bounds"]["observed"], got["delay_within_bounds"]["expected"]) == (
        "[10, 10]", "[-1800, 7200]")
    assert got["row_count_minimum"]["expected"] == ">= 10"


def test_layers_compare_by_day_and_by_count(spark):
    silver = spark.createDataFrame(
        [(D1, "t", "a", 1), (D2, "t", "a", 1), (D2, "t", "b", 1), (D2, "t", "c", None)], SILVER)
    gold = spark.createDataFrame([(D2, "t", "a", 1), (D3, "t", "a", 1)], SILVER)
    got = {r["service_date"]: r["status"] for r in Q.layer_diff(silver, gold).collect()}
    assert got == {D1: "missing", D2: "partial", D3: "orphan"}
    days_only = Q.layer_diff(silver, gold, counts=False)
    assert {r["status"] for r in days_only.collect()} == {"missing", "orphan"}


def test_null_parts_count_as_duplicates(spark):
    df = spark.createDataFrame([(D1, "t", "a", 1), (D1, None, "b", 1), (D1, "t", "a", 3)], SILVER)
    row = Q.dedupe_check(df).first()
    assert (row["events"], row["dupes"], row["median_delay"]) == (3, 2, 1)


def test_recent_days_are_the_newest(spark):
    df = spark.range(40).select(
        F.date_add(F.lit(D1), F.col("id").cast("int")).alias("service_date"),
        F.lit("t").alias("trip_id"), F.lit("s").alias("stop_id"), F.lit(1).alias(S.TARGET))
    assert Q.recent_days(df, 99).count() == 40
    assert Q.recent_days(df, 1).first()["service_date"] == date(2024, 2, 9)
    with pytest.raises(ValueError):
        Q.recent_days(df, 0)
    assert not Q.recent_days(df, 1).first()["usable"]
    assert Q.recent_days(df, 1, min_events=1).first()["usable"]


def test_null_rates_spot_empty_and_constant_features(spark):
    df = spark.createDataFrame([(D1, 1, None, 5), (D1, 1, None, 6)],
                               "service_date date, is_peak int, temp_c double, hist_n int")
    got = {r["feature"]: r for r in Q.null_rates(df, distinct=True).collect()}
    assert (got["temp_c"]["null_rate"], got["temp_c"]["is_constant"]) == (1.0, True)
    assert (got["is_peak"]["is_constant"], got["hist_n"]["is_constant"]) == (True, False)
    assert got["hist_n"]["distinct_values"] == 2
    missing = {r["feature"] for r in Q.uncovered(df).collect()}
    assert missing == set(S.FEATURE_NAMES) - {"is_peak", "hist_n"}


def test_offline_and_online_features_are_compared_with_a_tolerance(spark):
    offline = spark.createDataFrame([("t", 1.0, None), ("u", 2.0, 5.0)], "trip_id string, temp_c double, wind_kph double")
    same = spark.createDataFrame([("t", 1.0 + 1e-9, 10.0), ("u", 2.0, 5.0)], offline.schema)
    assert Q.feature_mismatches(offline, same, ["trip_id"]).count() == 0
    other = spark.createDataFrame([("t", 1.1, 10.0), ("u", 2.0, None)], offline.schema)
    got = {(r["trip_id"], r["feature"]) for r in Q.feature_mismatches(offline, other, ["trip_id"]).collect()}
    assert got == {("t", "temp_c"), ("u", "wind_kph")}


def test_trip_join_count_is_the_joins_row_count(spark):
    feed = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "trip_id string")
    trips = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "trip_id string")
    assert Q.trip_id_match(feed, trips).first()["joined_rows"] == feed.join(trips, "trip_id").count() == 5
    assert [tuple(r) for r in Q.trip_id_unmatched(feed, trips).collect()] == [("c", 1)]
    assert Q.trip_id_match(feed.limit(0), trips).first()["joined_rows"] == 0


PREDICTIONS = ("service_date date, trip_id string, stop_id string, predicted_delay_sec double, "
               "delay_t_minus_15 double, captured_at bigint")


def test_backtest_counts_repeats_unless_told_otherwise(spark):
    actuals = spark.createDataFrame([(D1, "t", "a", 100), (D1, "t", "b", None)], SILVER)
    predictions = spark.createDataFrame(
        [(D1, "t", "a", 90.0, 60.0, 1), (D1, "t", "a", 120.0, None, 2), (D1, "t", "b", 1.0, 1.0, 1),
         (D2, "t", "a", 1.0, 1.0, 1)], PREDICTIONS)
    row = B.backtest(predictions, actuals).first()
    assert (row["n"], row["model_mae"], row["persistence_mae"], row["schedule_mae"]) == (2, 15.0, 70.0, 100.0)
    latest = B.backtest(predictions, actuals, latest_only=True).first()
    assert (latest["n"], latest["model_mae"]) == (1, 20.0)
    assert B.backtest(predictions.where("stop_id = 'b'"), actuals).count() == 0


def test_zero_persistence_error_gives_no_ratio_and_no_pass(spark):
    actuals = spark.createDataFrame([(D1, "t", "a", 100)], SILVER)
    predictions = spark.createDataFrame([(D1, "t", "a", 90.0, 100.0, 1)], PREDICTIONS)
    assert B.backtest(predictions, actuals).first()["mae_ratio_vs_persistence"] is None
    scored = spark.createDataFrame([(100, 90.0, 100, 0)], "observed_delay_sec int, predicted_delay_sec double, delay_t_minus_15 int, hist_median_delay int")
    report = B.evaluation_report(scored).first()
    assert report["mae_ratio_vs_persistence"] is None and not report["passes_gate"]
    assert report["p90_abs_error"] == 10.0


def test_split_is_by_time(spark):
    df = spark.range(30).select(F.date_add(F.lit(D1), F.col("id").cast("int")).alias("service_date"))
    got = {r["service_date"].day: r["split"] for r in B.time_split(df).collect()}
    assert (got[16], got[17], got[23], got[24], got[30]) == (
        "train", "validation", "validation", "test", "test")

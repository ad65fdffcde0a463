from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators import gold as G
from headway.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
DAY = date(2024, 1, 20)


@pytest.fixture(scope="module")
def silver(spark):
    return Warehouse(spark, SF).silver()


def as_set(df):
    return sorted(map(str, df.collect()))


def test_priors_never_see_their_own_day_or_later(spark, silver):
    before = G.historical_priors(silver, DAY, min_count=1)
    future = F.col("service_date") >= F.lit(DAY)
    wrecked = silver.withColumn(
        S.TARGET, F.when(future, 7000).otherwise(F.col(S.TARGET))
    )
    assert before.count() > 0
    assert as_set(before) == as_set(G.historical_priors(wrecked, DAY, min_count=1))
    short = G.historical_priors(silver, DAY, lookback=3, min_count=1)
    old = F.col("service_date") < F.lit(DAY - timedelta(days=3))
    assert as_set(short) == as_set(
        G.historical_priors(silver.where(~old), DAY, min_count=1)
    )


def test_priors_match_the_engine_aggregates(spark, silver):
    got = G.historical_priors(silver, date(2024, 2, 1), min_count=2)
    past = silver.where("service_date >= '2024-01-04' AND observed_delay_sec IS NOT NULL")
    expected = past.groupBy(*G.CELL).agg(
        F.percentile_approx(S.TARGET, 0.5).alias("hist_median_delay"),
        F.percentile_approx(S.TARGET, 0.9).alias("hist_p90_delay"),
        F.stddev(S.TARGET).alias("hist_std_delay"),
        F.count(F.lit(1)).alias("hist_n"),
    ).where("hist_n >= 2")
    tidy = lambda df: as_set(df.withColumn("hist_std_delay", F.round("hist_std_delay", 6)))
    assert tidy(got) == tidy(expected)


def test_many_days_at_once_equal_one_day_each(spark, silver):
    days = [DAY, date(2024, 1, 25)]
    all_days = G.historical_priors_by_day(
        silver, spark.createDataFrame([(d,) for d in days], "as_of date"), min_count=2
    )
    asked = silver.where(F.col("service_date").isin(days)).select(
        F.col("service_date").alias("as_of"), *G.CELL
    )
    pruned = G.historical_priors_by_day(silver, asked, min_count=2)
    for d in days:
        one = G.historical_priors(silver, d, min_count=2)
        assert as_set(one) == as_set(all_days.where(F.col("as_of") == F.lit(d)).drop("as_of"))
        today = asked.where(F.col("as_of") == F.lit(d)).drop("as_of").distinct()
        assert as_set(one.join(today, list(G.CELL), "left_semi")) == as_set(
            pruned.where(F.col("as_of") == F.lit(d)).select(*one.columns)
        )


def test_asked_cells_are_met_in_slots_of_the_lookback(spark):
    """Over five slots of three days, with repeated, unknown and NULL cells: as by one date each."""
    made = [
        (date(2024, 1, 1) + timedelta(days=k % 14), None if k % 17 == 0 else f"R{k % 2}", "S", 0, k % 3, (k * 37) % 50)
        for k in range(400)
    ]
    daily = spark.createDataFrame(made, "service_date date, route_id string, stop_id string, is_weekend int, "
                                        "hour_of_day int, observed_delay_sec int").withColumn("n", F.lit(1))
    days = [date(2023, 12, 30) + timedelta(days=k) for k in range(20)]
    cells = daily.select(*G.CELL).union(daily.select(F.lit("R9"), "stop_id", "is_weekend", "hour_of_day"))
    asked = spark.createDataFrame([(d,) for d in days], "as_of date").crossJoin(cells)
    got = G.priors_of_histograms_by_day(daily, asked, lookback=3, min_count=2)
    known = daily.where("route_id IS NOT NULL")
    expected = [row for d in days for row in as_set(G.priors_of_histograms(known, d, 3, 2).select(
        F.lit(d).alias("as_of"), "*"))]
    assert expected and as_set(got) == sorted(expected)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan  # no row is copied to its dates before the shuffle


def test_features_of_one_day_equal_the_backfilled_day(spark, silver):
    one = G.build_features(silver, DAY, min_count=2, exact=True)
    assert one.columns == S.TRAINING_FEATURES_SCHEMA.names
    everything = G.build_features(silver, None, min_count=2, exact=True)
    assert one.count() > 0
    assert as_set(one) == as_set(everything.where(F.col("service_date") == F.lit(DAY)))
    pair = G.build_features(silver, [date(2024, 1, 25), DAY], min_count=2, exact=True)
    assert as_set(one) == as_set(pair.where(F.col("service_date") == F.lit(DAY)))
    assert {r[0] for r in pair.select("service_date").distinct().collect()} == {DAY, date(2024, 1, 25)}
    assert one.where("observed_delay_sec IS NULL").count() == 0
    assert one.select("temp_c", "visibility_m").distinct().collect() == [(10.0, 20000.0)]


def test_unlabelled_rows_take_part_in_windows(spark, silver):
    hidden = silver.withColumn(S.TARGET, F.when(F.col("stop_id") != "view", F.col(S.TARGET)))
    full = G.build_features(silver, None, exact=True)
    part = G.build_features(hidden, None, exact=True)
    cols = [*S.SILVER_KEY, "prev_stop_delay", "preceding_trip_delay", "mean_route_delay_15m"]
    assert as_set(part.select(*cols)) == as_set(full.where("stop_id <> 'view'").select(*cols))


def test_strict_route_state_looks_only_at_the_last_15_minutes(spark):
    rows = [("R", i, snap, d, v) for i, (snap, d, v) in enumerate([
        (1000, 10, "a"), (1000, 30, "b"), (1500, 50, "a"), (1899, 70, "c"), (1900, 90, "a"),
        (1901, 20, None), (2801, 5, "d"), (None, 99, "z"), (9000, 1, "q"),
    ])] + [(None, 50, 1000, 7, "n"), (None, 51, 1100, 8, "n")]
    df = spark.createDataFrame(
        [(date(2024, 1, 1), *r) for r in rows],
        "service_date date, route_id string, id int, snap_ts_t_minus_15 bigint, "
        "delay_t_minus_15 int, vehicle_id string",
    )
    got = {r["id"]: r for r in G.route_state(df, strict=True, exact=True).collect()}
    assert len(got) == len(rows)
    for route, i, snap, _, _ in rows:
        seen = [x for x in rows if snap is not None and x[0] == route and x[2] is not None
                and snap - 900 <= x[2] <= snap - 1]
        mean = sum(x[3] for x in seen) / len(seen) if seen else None
        assert got[i]["mean_route_delay_15m"] == mean
        vehicles = None if snap is None else len({x[4] for x in seen if x[4]})
        assert got[i]["vehicles_active_on_route"] == vehicles


def test_weather_rows_of_one_hour_do_not_multiply_events(spark):
    events = spark.createDataFrame(
        [(date(2024, 1, 1), 5, "a"), (date(2024, 1, 1), 6, "b")],
        "service_date date, hour_of_day int, id string")
    weather = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5, 0), 1.0, 0.0, 3.0, 9.0),
         (datetime(2024, 1, 1, 5, 30), 3.0, 0.0, 5.0, 9.0)], S.WEATHER_SCHEMA)
    got = {r["id"]: r for r in G.join_weather(events, weather).collect()}
    assert (got["a"]["temp_c"], got["a"]["wind_kph"]) == (2.0, 4.0)
    assert got["b"]["temp_c"] is None
    assert len(got) == 2


def test_strict_route_state_as_by_brute_force(spark):
    """Vehicles that come back, equal times, rows without time, vehicle or delay."""
    import random

    rng = random.Random(3)
    rows = []
    for k in range(400):
        at = None if k % 23 == 0 else 1_700_000_000 + rng.choice([rng.randrange(0, 9000), rng.randrange(0, 9000) // 900 * 900])
        rows.append((date(2024, 1, 5), rng.choice(["R", "Q", None]), f"T{k}", "s", rng.choice(["V1", "V2", "V3", "V4", None]),
                     at, rng.choice([None, *range(-60, 600, 7)])))
    df = spark.createDataFrame(rows, "service_date date, route_id string, trip_id string, stop_id string, "
                               "vehicle_id string, snap_ts_t_minus_15 long, delay_t_minus_15 int")
    got = {r["trip_id"]: (r["mean_route_delay_15m"], r["vehicles_active_on_route"])
           for r in G.route_state(df, strict=True).collect()}
    for _, route, trip, _, _, at, _ in rows:
        seen = [r for r in rows if at is not None and r[1] == route and r[5] is not None and at - 900 <= r[5] <= at - 1]
        delays = [r[6] for r in seen if r[6] is not None]
        mean = sum(delays) / len(delays) if delays else None
        vehicles = None if at is None else len({r[4] for r in seen} - {None})
        assert got[trip] == (mean, vehicles), trip

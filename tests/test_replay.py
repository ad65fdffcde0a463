"""Live state as it was at a moment, and the comparison of stored with replayed features."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators import live, quality

FIELDS = ("record_type string, route_id string, stop_id string, trip_id string, stop_sequence int, "
          "vehicle_id string, arrival_delay int, ingest_ts bigint, extra string")


@pytest.fixture(scope="module")
def feed(spark):
    pick = random.Random(7)
    rows = []
    for n in range(600):
        at = pick.choice([None, *range(0, 20_000, 250)])
        where = (pick.choice(["R1", "R1", "R1", "R2", "", None]), pick.choice(["a", "b", "", None]))
        if n % 3 == 0:
            rows.append(("vehicle_positions", where[0], None, "t", None, pick.choice(["v", "w", "", None]), None, at, "x"))
        else:
            delay = pick.choice([None, 0, 60, 61, 7200, 7201, -1800, -1801])
            rows.append(("trip_updates", *where, pick.choice(["t", "u", None]), pick.choice([1, 2, None]), "v", delay, at, "x"))
    rows += rows[:40]
    return spark.createDataFrame(rows, FIELDS)


MOMENTS = (-1, 0, 249, 250, 900, 901, 7199, 7200, 7201, 14_400, 19_999, 50_000)


@pytest.fixture(scope="module")
def asked(spark):
    places = [("R1", "a"), ("R1", "b"), ("R2", "a"), ("R9", "a"), (None, "a"), ("R1", None)]
    return spark.createDataFrame(
        [(r, s, m) for r, s in places for m in (*MOMENTS, None)] + [("R1", "a", 250)],
        "route_id string, stop_id string, asked_at bigint",
    )


def test_stop_state_at_equals_the_state_of_the_rows_until_then(feed, asked):
    got = {(r["route_id"], r["stop_id"], r["asked_at"]): (r["current_delay"], r["trip_id"], r["stop_sequence"], r["updated_at"])
           for r in live.stop_state_at(feed, asked).collect()}
    expected = {}
    for m in MOMENTS:
        state = live.stop_state(feed.where(F.col("ingest_ts") <= m), F.lit(m))
        for r in state.where(F.col("updated_at") > m - S.STATE_TTL_SECONDS).collect():
            if (r["route_id"], r["stop_id"]) in {("R1", "a"), ("R1", "b"), ("R2", "a")}:
                expected[r["route_id"], r["stop_id"], m] = (
                    r["current_delay"], r["trip_id"], r["stop_sequence"], r["updated_at"])
    assert len(expected) > 15
    assert got == expected


def test_route_state_at_counts_the_quarter_of_an_hour_before(feed, asked):
    got = {(r["route_id"], r["asked_at"]): (r["mean_route_delay_15m"], r["vehicles_active_on_route"])
           for r in live.route_state_at(feed, asked).collect() if r["route_id"]}
    rows = feed.collect()
    for (route, m), (mean, vehicles) in got.items():
        near = [r for r in rows if r["route_id"] == route and r["ingest_ts"] is not None and m - 900 <= r["ingest_ts"] < m]
        delays = [r["arrival_delay"] for r in near if r["record_type"] == "trip_updates" and r["stop_id"]
                  and r["arrival_delay"] is not None and -1800 <= r["arrival_delay"] <= 7200]
        assert mean == (pytest.approx(sum(delays) / len(delays)) if delays else None)
        assert vehicles == len({r["vehicle_id"] for r in near if r["record_type"] == "vehicle_positions" and r["vehicle_id"]})
    assert {k[0] for k in got} == {"R1", "R2", "R9"} and len(got) == 3 * len(MOMENTS)


def test_every_question_is_answered_once(spark, feed, asked):
    priors = spark.createDataFrame([], "as_of date, route_id string, stop_id string, is_weekend int, "
                                       "hour_of_day int, hist_median_delay int, hist_n bigint")
    keyed = asked.withColumns({"service_date": F.lit("2024-01-01"), "trip_id": F.lit("mine"),
                               "n": F.monotonically_increasing_id()})
    out = live.replayed_features(keyed, feed, priors)
    assert out.count() == asked.count()
    assert {r["trip_id"] for r in out.collect()} == {"mine"}
    assert out.where("route_id = 'R1' AND stop_id = 'a' AND asked_at = 250").select("hour_of_day").collect()[0][0] == 0
    assert live.replayed_features(keyed.limit(0), feed, priors).count() == 0
    assert live.replayed_features(keyed, feed.limit(0), priors).where("delay_t_minus_15 IS NOT NULL").count() == 0


def test_parity_fails_when_a_feature_drifts(spark):
    same = spark.createDataFrame([(1, 60.0, 5), (2, None, 5), (3, 61.0, 5)], "k int, delay_t_minus_15 double, hist_n int")
    drifted = same.withColumn("hist_n", F.when(F.col("k") == 3, 9).otherwise(F.col("hist_n")))
    rows = {r["feature"]: r for r in quality.feature_parity(same, drifted, ["k"]).collect()}
    assert len(rows) == len(S.FEATURE_NAMES)
    assert {n for n, r in rows.items() if r["differing"]} == {"hist_n"}
    assert (rows["hist_n"]["compared"], rows["hist_n"]["differing"], rows["hist_n"]["largest"]) == (3, 1, 4.0)
    assert quality.feature_parity(same, same, ["k"]).agg(F.sum("differing")).first()[0] == 0

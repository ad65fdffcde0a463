from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators import silver as V
from headway.sources import adapters

SF = "/root/testdata/sf0.001"


def updates(spark, rows):
    """Rows of (trip, stop, ingest, arrival, delay) with overridable extras."""
    base = dict(
        record_type="trip_updates", feed_timestamp=0, route_id="R1", direction_id=0,
        start_date="20240105", schedule_relationship=None, vehicle_id="V1", stop_sequence=1,
        departure_time=None, departure_delay=None,
    )
    full = []
    for trip, stop, ingest, arrival, delay, *extra in rows:
        row = {**base, "trip_id": trip, "stop_id": stop, "ingest_ts": ingest,
               "arrival_time": arrival, "arrival_delay": delay, **(extra[0] if extra else {})}
        full.append(tuple(row[n] for n in S.TRIP_UPDATES_ROW.names))
    return spark.createDataFrame(full, S.TRIP_UPDATES_ROW)


def test_cancelled_and_keyless_rows_go_but_unknown_status_stays(spark):
    df = updates(spark, [
        ("T", "a", 1, 1, 1), ("T", "b", 1, 1, 1, {"schedule_relationship": 3}),
        ("T", "c", 1, 1, 1, {"schedule_relationship": 0}), (None, "d", 1, 1, 1),
        ("T", None, 1, 1, 1), ("T", "e", 1, 1, 1, {"start_date": None}),
    ])
    assert sorted(r["stop_id"] for r in V.valid_updates(df).collect()) == ["a", "c"]


def test_latest_wins_and_ties_are_total(spark):
    df = updates(spark, [
        ("T", "a", 10, 100, 5), ("T", "a", 20, 90, 7), ("T", "a", 20, 95, None),
        ("T", "a", 20, 95, 3), ("T", "a", 20, None, 99),
    ])
    row = V.collapse(df, horizons=()).first()
    assert (row["last_seen_ts"], row["observed_arrival_epoch"], row["observed_delay_sec"]) == (20, 95, 3)
    assert V.latest_per_key(df).first()["arrival_delay"] == 3


def test_snapshot_is_one_sided(spark):
    h = 15 * 60
    df = updates(spark, [
        ("T", "a", 0, h + 500, 1),       # early candidate
        ("T", "a", 100, h + 100, 2),     # exactly at the horizon
        ("T", "a", 101, h + 100, 3),     # one second inside: not a candidate
        ("T", "a", 300, None, 4),
        ("T", "b", 10, 20, 5),
    ])
    rows = {r["stop_id"]: r for r in V.snapshot_at(df, 15).collect()}
    assert set(rows) == {"a"}
    assert (rows["a"]["delay_t_minus_15"], rows["a"]["snap_ts_t_minus_15"]) == (2, 100)
    fused = {r["stop_id"]: r for r in V.collapse(df).collect()}
    assert fused["a"]["delay_t_minus_15"] == 2 and fused["b"]["delay_t_minus_15"] is None


def test_fused_collapse_equals_ranked_windows(spark):
    feed = V.valid_updates(adapters.trip_updates(spark, SF))
    fused = V.collapse(feed).select(*S.KEY, "last_seen_ts", "delay_t_minus_5", "delay_t_minus_30")
    newest = Window.partitionBy(*S.KEY).orderBy(F.col("ingest_ts").desc())
    expected = feed.withColumn("rn", F.row_number().over(newest)).where("rn = 1").select(
        *S.KEY, F.col("ingest_ts").alias("last_seen_ts")
    )
    for m in (5, 30):
        gap = F.col("arrival_time") - F.col("ingest_ts") - m * 60
        near = Window.partitionBy(*S.KEY).orderBy(gap, F.col("ingest_ts").desc(),
                                                  F.col("arrival_delay").desc())
        snap = feed.where(gap >= 0).withColumn("rn", F.row_number().over(near)).where("rn = 1")
        expected = expected.join(
            snap.select(*S.KEY, F.col("arrival_delay").alias(f"delay_t_minus_{m}")),
            list(S.KEY), "left",
        )
    assert sorted(map(str, fused.collect())) == sorted(map(str, expected.collect()))


def dims(spark):
    text = "string"
    return {
        "stop_times": spark.createDataFrame(
            [("T", "a", "1", "08:00:00", "1.5"), ("T", "a", "9", "25:10:00", "13.5"),
             ("T", "a", "9", "25:10:00", "13.5"), ("T", "b", "x", "08:05:00", None)],
            f"trip_id {text}, stop_id {text}, stop_sequence {text}, arrival_time {text}, "
            f"shape_dist_traveled {text}",
        ),
        "stops": spark.createDataFrame([("a", "49.1", "-123.1"), ("b", "bad", None)],
                                       "stop_id string, stop_lat string, stop_lon string"),
        "trips": spark.createDataFrame([("T", "R2"), ("T", "R1"), ("U", "R3")],
                                       "trip_id string, route_id string"),
        "routes": spark.createDataFrame([("R1", "one", "3"), ("R2", "two", "3")],
                                        "route_id string, route_short_name string, route_type string"),
    }


def test_loop_trips_do_not_fan_out_and_prefer_their_own_visit(spark):
    df = updates(spark, [
        ("T", "a", 1, 1704412800, 60, {"stop_sequence": 9, "route_id": None}),
        ("T", "b", 1, 1704412900, 9000, {"stop_sequence": 2}),
        ("X", "a", 1, None, None, {"stop_sequence": 4, "route_id": None}),
        ("T", "c", 1, 1704499200, 10, {"stop_sequence": 3}),
    ])
    rows = {(r["trip_id"], r["stop_id"]): r for r in V.build_silver(df, **dims(spark)).collect()}
    assert len(rows) == 4
    loop = rows["T", "a"]
    assert (loop["scheduled_arrival"], loop["shape_dist_traveled"]) == ("25:10:00", 13.5)
    assert (loop["route_id"], loop["route_short_name"]) == ("R1", "one")
    assert loop["service_date"] == date(2024, 1, 5)
    assert (loop["stops_remaining"], loop["is_terminus"]) == (0, 1)
    # Friday, midnight UTC
    assert (loop["hour_of_day"], loop["day_of_week"], loop["is_weekend"]) == (0, 6, 0)
    assert rows["T", "b"]["observed_delay_sec"] is None
    assert rows["T", "b"]["scheduled_arrival"] == "08:05:00"
    assert (rows["T", "b"]["stops_remaining"], rows["T", "b"]["is_terminus"]) == (7, 0)
    assert rows["X", "a"]["route_id"] is None and rows["X", "a"]["hour_of_day"] is None
    assert rows["T", "c"]["is_weekend"] == 1


def test_zone_moves_hour_and_weekday(spark):
    df = updates(spark, [("T", "a", 1, 1704412800, 60)])
    row = V.build_silver(df, **dims(spark), zone="America/Vancouver").first()
    assert (row["hour_of_day"], row["day_of_week"]) == (16, 5)


def test_schema_matches_the_declared_one(spark):
    df = V.build_silver(updates(spark, [("T", "a", 1, 1, 1)]), **dims(spark))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in S.STOP_EVENTS_SCHEMA
    ]


def test_filters_and_columns_reach_the_scan(spark):
    plan = V.snapshot_at(V.valid_updates(adapters.trip_updates(spark, SF)), 15)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in text
    assert text.count("Exchange hashpartitioning") == 1

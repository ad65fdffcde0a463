from __future__ import annotations

import json

from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.feed import (
    flatten_trip_updates,
    flatten_vehicle_positions,
    pack_rows,
    parse_rows,
    unpack_rows,
)

MESSAGE = {
    "header": {"timestamp": 1770000000},
    "entity": [
        {
            "id": "trip-1",
            "trip_update": {
                "trip": {"trip_id": "T-123", "route_id": "099", "start_date": "20260805"},
                "vehicle": {"id": "V-9"},
                "stop_time_update": [
                    {"stop_id": "61935", "stop_sequence": 4,
                     "arrival": {"time": 1770000600, "delay": 120}},
                    {"stop_id": "61936", "stop_sequence": 5},
                ],
            },
        },
        {
            "id": "veh-1",
            "vehicle": {
                "vehicle": {"id": "V-9"}, "trip": {"trip_id": "T-123", "route_id": ""},
                "position": {"latitude": 49.2827, "longitude": -123.1207},
                "current_stop_sequence": 4, "timestamp": 1770000000,
            },
        },
    ],
}


def feed(spark):
    text = spark.createDataFrame([(json.dumps(MESSAGE),)], "value string")
    parsed = text.select(F.from_json("value", S.FEED_MESSAGE_DDL).alias("m")).select("m.*")
    return parsed.withColumn("ingest_ts", F.lit(1770000100).cast("bigint"))


def test_one_row_per_stop_time_update(spark):
    rows = flatten_trip_updates(feed(spark)).orderBy("stop_sequence").collect()
    assert len(rows) == 2
    first, second = rows
    assert (first["trip_id"], first["route_id"], first["stop_id"]) == ("T-123", "099", "61935")
    assert (first["arrival_delay"], first["ingest_ts"]) == (120, 1770000100)
    assert first["record_type"] == "trip_updates"
    assert first["schedule_relationship"] == 0
    assert second["arrival_time"] is None and second["arrival_delay"] is None
    assert second["direction_id"] is None


def test_vehicle_positions(spark):
    rows = flatten_vehicle_positions(feed(spark)).collect()
    assert len(rows) == 1
    assert rows[0]["vehicle_id"] == "V-9"
    assert abs(rows[0]["latitude"] - 49.2827) < 1e-6
    assert rows[0]["route_id"] is None and rows[0]["bearing"] is None


def test_pack_then_unpack_is_the_identity_and_records_are_bounded(spark):
    rows = spark.range(1234, numPartitions=3).select(
        F.lit("trip_updates").alias("record_type"),
        F.col("id").alias("ingest_ts"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("R"), F.col("id"))).alias("route_id"),
        F.lit("V1").alias("vehicle_id"),
    )
    packed = pack_rows(rows, size=100)
    sizes = [r["rows"] for r in packed.collect()]
    assert sum(sizes) == 1234 and max(sizes) == 100
    assert all(r["value"].endswith("\n") for r in packed.collect())
    assert {r["partition_key"] for r in packed.collect()} <= {"V1"} | {f"R{i}" for i in range(1234)}
    good, bad = parse_rows(unpack_rows(packed.select("value")), rows.schema)
    assert bad.count() == 0
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, rows.collect()))


def test_malformed_lines_are_set_aside(spark):
    text = '{"record_type": "trip_updates", "ingest_ts": 5}\n\n  \nnot json\n{"ingest_ts": \r\n{"ingest_ts": 7}\n'
    lines = unpack_rows(spark.createDataFrame([(text,)], "value string"))
    assert lines.count() == 4
    good, bad = parse_rows(lines, S.LIVE_ROW)
    assert sorted(r["ingest_ts"] for r in good.collect()) == [5, 7]
    assert sorted(r["line"] for r in bad.collect()) == ["not json", '{"ingest_ts":']


def test_numeric_text_delays_survive_the_live_schema(spark):
    lines = spark.createDataFrame([('{"arrival_delay": "90"}',), ('{"arrival_delay": 91}',)], "line string")
    good, bad = parse_rows(lines, S.LIVE_ROW)
    assert bad.count() == 0
    assert sorted(r["arrival_delay"] for r in good.collect()) == ["90", "91"]

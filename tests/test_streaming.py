from __future__ import annotations

import json

from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators import live as L
from headway.operators.feed import pack_rows, parse_rows, unpack_rows
from headway.operators.silver import build_silver
from headway.plans.warehouse import Warehouse
from headway.sources import adapters
from headway.sources.tables import read_bronze
from headway.streaming import streams as T

SF = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


def live_rows(spark, rows):
    """Rows of (route, stop, vehicle, ingest, delay text, kind)."""
    full = [
        {"route_id": r, "stop_id": s, "vehicle_id": v, "ingest_ts": t, "arrival_delay": d,
         "record_type": kind, "trip_id": f"T{t}", "stop_sequence": 1}
        for r, s, v, t, d, kind in rows
    ]
    lines = spark.createDataFrame([(json.dumps(x),) for x in full], "line string")
    return parse_rows(lines, S.LIVE_ROW)[0]


def put(spark, folder, rows):
    pack_rows(rows).write.mode("append").parquet(folder)


def state(spark, path, kind, *columns):
    return sorted(map(tuple, T.read_state(spark, path, kind).select(*columns).collect()))


UP, POS = "trip_updates", "vehicle_positions"


def test_stop_state_takes_the_newest_plausible_row(spark):
    rows = live_rows(spark, [
        ("R", "a", None, 1, "10", UP), ("R", "a", None, 3, "20.12345", UP), ("R", "a", None, 4, "9999", UP),
        ("R", "a", None, 5, "soon", UP), ("", "a", None, 6, "1", UP), ("R", None, None, 6, "1", UP),
        ("R", "a", "V", 9, "1", POS), ("R", "b", None, None, "5", UP),
    ])
    got = {r["stop_id"]: r for r in L.stop_state(rows, F.lit(1000).cast("bigint")).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["current_delay"], got["a"]["updated_at"], got["a"]["ttl"]) == (20.123, 3, 8200)
    assert (got["a"]["pk"], got["a"]["sk"]) == ("ROUTE#R#STOP#a", "CURRENT")
    assert got["b"]["updated_at"] == 1000


def test_route_state_needs_a_plausible_delay(spark):
    rows = live_rows(spark, [
        ("R", "a", None, 1, "10", UP), ("R", "b", None, 1, "20", UP), ("R", None, "V1", 1, None, POS),
        ("R", None, "V1", 2, None, POS), ("R", None, "V2", 1, None, POS), ("Q", None, "V3", 1, None, POS),
        ("P", "a", "V9", 1, "5", UP), ("N", "a", "V9", 1, "99999", UP),
    ])
    got = {r["route_id"]: (r["mean_route_delay_15m"], r["vehicles_active_on_route"])
           for r in L.route_state_batch(rows).collect()}
    assert got == {"R": (15.0, 2), "P": (5.0, 0)}


def test_live_state_never_goes_backwards_and_expires(spark, tmp_path):
    newer = live_rows(spark, [("R", "a", None, 100, "50", UP), ("R", "b", None, 90, "1", UP)])
    older = live_rows(spark, [("R", "a", None, 40, "7", UP), ("R", "c", None, 95, "2", UP)])
    seen = []
    for name, order in (("x", (newer, older)), ("y", (older, newer)), ("z", (newer, older, newer))):
        path, feed = str(tmp_path / name), str(tmp_path / f"feed-{name}")
        for batch in order:
            put(spark, feed, batch)
            q = T.start_live_state(T.stream_rows(spark, feed), path, f"{path}-log", trigger=ONCE,
                                   clock=F.lit(1000).cast("bigint"))
            q.awaitTermination()
        seen.append(state(spark, path, "stops", "stop_id", "current_delay", "updated_at"))
    assert seen[0] == seen[1] == seen[2] == [("a", 50.0, 100), ("b", 1.0, 90), ("c", 2.0, 95)]
    stops = T.read_state(spark, str(tmp_path / "x"), "stops")
    assert L.alive(stops, 8199).count() == 3 and L.alive(stops, 8200).count() == 0


def test_route_state_follows_the_last_batch(spark, tmp_path):
    path, feed = str(tmp_path / "s"), str(tmp_path / "f")
    for clock, delay in ((10, "4"), (10, "8")):
        put(spark, feed, live_rows(spark, [("R", "a", None, 1, delay, UP)]))
        T.start_live_state(T.stream_rows(spark, feed), path, f"{path}-log", trigger=ONCE,
                           clock=F.lit(clock).cast("bigint")).awaitTermination()
    assert state(spark, path, "routes", "route_id", "mean_route_delay_15m") == [("R", 8.0)]


def test_landing_routes_by_type_and_keeps_bad_lines(spark, tmp_path):
    feed, root = str(tmp_path / "feed"), str(tmp_path / "bronze")
    good = live_rows(spark, [("R", "a", None, 3600 * 5, "10", UP), ("R", None, "V", 3600 * 6, None, POS)])
    odd = live_rows(spark, [("R", "a", None, 1, "1", "alerts"), ("R", "a", None, 1, "1", None)])
    put(spark, feed, good.withColumn("arrival_delay", F.col("arrival_delay").cast("int")))
    put(spark, feed, odd.drop("arrival_delay"))
    spark.createDataFrame([("k", "{broken\n", 1)], "partition_key string, value string, rows int").write.mode(
        "append").parquet(feed)
    for q in T.land_bronze(T.stream_rows(spark, feed), root, str(tmp_path / "log"), ONCE,
                           F.timestamp_seconds("ingest_ts")):
        q.awaitTermination()
    updates = read_bronze(spark, f"{root}/raw", "trip_updates", "1970-01-01").collect()
    assert [(r["route_id"], r["arrival_delay"], r["hour"]) for r in updates] == [("R", 10, "05")]
    assert read_bronze(spark, f"{root}/raw", "vehicle_positions").first()["hour"] == "06"
    errors = [r["line"] for r in spark.read.json(f"{root}/errors").collect()]
    assert len(errors) == 3 and "{broken" in errors


def test_landing_in_one_pass_replaces_a_batch_that_comes_again(spark, tmp_path):
    feed, root = str(tmp_path / "feed"), str(tmp_path / "bronze")
    put(spark, feed, live_rows(spark, [
        ("R", "a", None, 3600 * 5, "10", UP), ("R", None, "V", 3600 * 6, None, POS), ("R", "a", None, 1, "1", "alerts"),
        ("R", "b", None, None, "1", UP),
    ]).withColumn("arrival_delay", F.col("arrival_delay").cast("int")))
    spark.createDataFrame([("k", "{broken\n", 1)], "partition_key string, value string, rows int").write.mode(
        "append").parquet(feed)
    for log in ("log", "again"):  # a fresh checkpoint delivers batch 0 once more
        T.start_landing(T.stream_rows(spark, feed), root, str(tmp_path / log), ONCE,
                        F.coalesce(F.timestamp_seconds("ingest_ts"), F.lit("1970-01-01").cast("timestamp"))).awaitTermination()
        updates = read_bronze(spark, f"{root}/raw", "trip_updates", "1970-01-01").collect()
        assert sorted((r["stop_id"], r["arrival_delay"], r["hour"]) for r in updates) == [("a", 10, "05"), ("b", 1, "00")]
        assert read_bronze(spark, f"{root}/raw", "vehicle_positions").count() == 1
        errors = sorted(r["line"] for r in spark.read.json(f"{root}/errors").collect())
        assert len(errors) == 2 and any("alerts" in e for e in errors) and "{broken" in errors


def test_streamed_silver_equals_the_batch(spark, tmp_path):
    w = Warehouse(spark, SF)
    rows = w.trip_updates().select(*S.TRIP_UPDATES_ROW.names)
    feed, path = str(tmp_path / "feed"), str(tmp_path / "silver")
    # Three triggers whose rows interleave: each sees a part of most trips, in no order.
    for part in (1, 0, 2):
        put(spark, feed, rows.where(F.pmod(F.xxhash64("ingest_ts"), F.lit(3)) == part))
        T.start_silver(T.stream_rows(spark, feed), path, f"{path}-log", w.dims(), ONCE).awaitTermination()
    got = spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path)
    expected = build_silver(w.trip_updates(), **w.dims()).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_native_stop_state_equals_the_batch(spark, tmp_path):
    rows = adapters.trip_updates(spark, SF).select(*S.LIVE_ROW.names[:15])
    feed = str(tmp_path / "feed")
    put(spark, feed, rows)
    parsed, _ = parse_rows(T.stream_rows(spark, feed), S.LIVE_ROW)
    q = (T.stop_state_stream(parsed).writeStream.outputMode("complete").format("memory")
         .queryName("native_stops").trigger(**ONCE).start())
    q.awaitTermination()
    columns = ["route_id", "stop_id", "current_delay", "updated_at"]
    expected = L.stop_state(rows).select(*columns)
    got = spark.table("native_stops").select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_native_route_state_slides_and_drops_late_rows(spark, tmp_path):
    feed = str(tmp_path / "feed")
    log = str(tmp_path / "log")
    out = str(tmp_path / "out")

    def run():
        parsed, _ = parse_rows(T.stream_rows(spark, feed), S.LIVE_ROW)
        sliding = T.route_state_stream(parsed, "15 minutes", "5 minutes").select(
            F.unix_timestamp("window.start").alias("start"), "route_id", "mean_route_delay_15m",
            "vehicles_active_on_route")
        q = (sliding.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", log).trigger(**ONCE).start())
        q.awaitTermination()

    t = 1_700_000_100 // 900 * 900
    put(spark, feed, live_rows(spark, [("R", "a", "V1", t, "10", UP), ("R", "a", "V2", t + 60, "30", UP)]))
    run()
    put(spark, feed, live_rows(spark, [("R", "a", "V3", t + 7200, "50", UP)]))
    run()
    put(spark, feed, live_rows(spark, [("R", "a", "V4", t + 61, "999", UP)]))  # past the watermark
    run()
    got = {r["start"] - t: (r["mean_route_delay_15m"], r["vehicles_active_on_route"])
           for r in spark.read.parquet(out).where(F.col("start") < t + 900).collect()}
    assert got == {-600: (20.0, 2), -300: (20.0, 2), 0: (20.0, 2)}


def test_text_source_of_plain_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"record_type": "trip_updates"}\n\nnope\n')
    lines = T.stream_rows(spark, str(tmp_path / "in"), format="text")
    q = lines.writeStream.format("memory").queryName("plain_lines").trigger(**ONCE).start()
    q.awaitTermination()
    assert spark.table("plain_lines").count() == 2
    assert unpack_rows(spark.createDataFrame([("a\nb",)], "value string")).count() == 2


def test_changed_keys_only_and_expired_keys_leave(spark, tmp_path):
    feed, log, out = (str(tmp_path / n) for n in ("feed", "log", "out"))

    def run(rows):
        put(spark, feed, live_rows(spark, rows))
        T.start_stop_changes(T.stream_rows(spark, feed), out, log, ttl=600, trigger=ONCE).awaitTermination()
        return {(r["stop_id"], r["updated_at"] - t, r["expired"]) for r in spark.read.parquet(out).collect()}

    t = 1_700_000_000
    first = run([("R", s, "V", t + k, "10", UP) for k, s in enumerate("abcdefgh")])
    assert first == {(s, k, False) for k, s in enumerate("abcdefgh")}
    second = run([("R", "a", "V", t + 100, "20", UP), ("R", "b", "V", t - 50, "99", UP)])  # b: an older version
    assert second - first == {("a", 100, False)}
    third = run([("R", "a", "V", t + 950, "30", UP)])  # the watermark comes to t + 650
    assert third - second == {("a", 950, False)} | {(s, k, True) for k, s in enumerate("bcdefgh", 1)}
    fourth = run([("R", "c", "V", t + 900, "40", UP), ("R", "d", "V", t + 10, "50", UP)])  # d: behind the watermark
    assert fourth - third == {("c", 900, False)}
    alive = {r["stop_id"]: r["current_delay"] for r in T.state_of_changes(spark.read.parquet(out)).collect()}
    assert alive == {"a": 30.0, "c": 40.0}


def test_stream_silver_packs_in_the_tasks_that_read(spark, tmp_path, monkeypatch):
    """No part of the feed is gathered in one task; parts by hour, also of rows without a time, give silver."""
    from headway.plans import queries as registered
    from headway.plans.warehouse import Warehouse

    spark.range(600).repartition(6).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 900) AS ts", "id % 60 AS user_id",
        "element_at(array('signup', 'view', 'click'), cast(id % 3 AS int) + 1) AS event_type",
        "cast(id % 120 AS double) AS value", "concat('{\"k\": ', cast(id % 40 AS string), '}') AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    packed, asked, pack, read = [], [], registered.feed.pack_rows, registered.streams.stream_rows
    monkeypatch.setattr(registered.feed, "pack_rows", lambda rows: packed.append(rows) or pack(rows))
    monkeypatch.setattr(registered.streams, "stream_rows", lambda *a, max_files: asked.append(max_files) or read(*a, max_files=max_files))
    got = registered.queries()["stream_silver"](spark, str(tmp_path))
    plans = [rows._jdf.queryExecution().optimizedPlan().toString() for rows in packed]
    assert len(packed) == 4 and not any("Repartition" in p for p in plans)
    assert sum(rows.count() for rows in packed) == 600 and asked[0] >= 1
    silver = registered.dates_as_text(registered._silver_out(Warehouse(spark, str(tmp_path)).silver()))
    assert sorted(map(str, got.collect())) == sorted(map(str, silver.collect())) != []

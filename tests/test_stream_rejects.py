"""Streamed rows whose start date is no date are kept apart and counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.feed import pack_rows
from headway.operators.silver import build_silver
from headway.plans.warehouse import Warehouse
from headway.streaming import streams as T

SF = "/root/testdata/sf0.001"


def test_streamed_rows_without_a_date_are_rejected_with_a_count(spark, tmp_path, caplog):
    w = Warehouse(spark, SF)
    rows = w.trip_updates().select(*S.TRIP_UPDATES_ROW.names)
    bad = rows.where(F.col("trip_id") == rows.agg(F.min("trip_id")).first()[0])
    bad = bad.withColumn("start_date", F.lit("2024-13"))
    feed, path = str(tmp_path / "feed"), str(tmp_path / "silver")
    dims = w.dims()
    for part in (rows.unionByName(bad), bad):
        pack_rows(part).write.mode("append").parquet(feed)
        T.start_silver(
            T.stream_rows(spark, feed), path, f"{path}-log", dims, {"availableNow": True}
        ).awaitTermination()
    expected = build_silver(bad, **dims).count()
    rejects = spark.read.parquet(f"{path}_rejects")
    assert {r["batch"]: r["count"] for r in rejects.groupBy("batch").count().collect()} == {
        0: expected, 1: expected}
    assert {r["start_date"] for r in rejects.select("start_date").distinct().collect()} == {"2024-13"}
    assert [r.getMessage() for r in caplog.records if "rejected" in r.getMessage()] == [
        f"batch {n}: {expected} rows without a service date rejected" for n in (0, 1)]
    kept = spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path)
    clean = build_silver(rows, **dims).select(*kept.columns)
    assert sorted(map(str, kept.collect())) == sorted(map(str, clean.collect()))

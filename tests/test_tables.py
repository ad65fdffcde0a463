from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions import feature_columns
from headway.operators.quality import dq_rules
from headway.sinks import tables as W
from headway.sources import adapters, static
from headway.sources import tables as R

ROWS = "d string, k int, ver bigint, x int, snap int"


def merged(spark, target, staged, **kw):
    t, s = spark.createDataFrame(target, ROWS), spark.createDataFrame(staged, ROWS)
    return sorted(map(tuple, W.merge_newer(t, s, ["d", "k"], "ver", **kw).collect()))


def test_merge_takes_only_strictly_newer_rows(spark):
    old = [("a", 1, 5, 1, 1)]
    assert merged(spark, old, [("a", 1, 6, 2, None)]) == [("a", 1, 6, 2, None)]
    assert merged(spark, old, [("a", 1, 5, 2, 2)]) == old
    assert merged(spark, old, [("a", 1, 4, 2, 2)]) == old
    assert merged(spark, old, [("a", 1, None, 2, 2)]) == old
    unknown = [("a", 1, None, 1, 1)]
    assert merged(spark, unknown, [("a", 1, 9, 2, 2)]) == unknown
    assert merged(spark, old, [("b", 1, None, 2, 2)]) == [*old, ("b", 1, None, 2, 2)]


def test_carried_columns_keep_what_the_newer_row_lacks(spark):
    got = merged(spark, [("a", 1, 5, 1, 7)], [("a", 1, 6, None, None)], carry_cols=["snap"])
    assert got == [("a", 1, 6, None, 7)]


def test_upsert_is_idempotent_order_insensitive_and_local(spark, tmp_path):
    batches = [
        [("a", 1, 5, 1, 1), ("b", 1, 5, 1, 1)],
        [("a", 1, 7, 3, 3), ("a", 2, 1, 9, 9)],
        [("a", 1, 6, 2, 2)],
    ]
    results = []
    for i, order in enumerate(([0, 1, 2, 1], [2, 1, 0], [1, 2, 0, 2])):
        path = str(tmp_path / str(i))
        for b in order:
            touched = W.upsert(
                spark, path, spark.createDataFrame(batches[b], ROWS), ["d", "k"], "ver", "d"
            )
            assert touched == sorted({r[0] for r in batches[b]})
        back = spark.read.parquet(path).select("d", "k", "ver", "x", "snap")
        results.append(sorted(map(tuple, back.collect())))
    assert results[0] == results[1] == results[2]
    assert results[0] == [("a", 1, 7, 3, 3), ("a", 2, 1, 9, 9), ("b", 1, 5, 1, 1)]
    assert W.upsert(spark, str(tmp_path / "0"), spark.createDataFrame([], ROWS), ["d", "k"],
                    "ver", "d") == []


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "gold")
    for d, n in (("2024-01-01", 3), ("2024-01-02", 4), ("2024-01-01", 2)):
        W.write_partitions(spark.range(n).withColumn("d", F.lit(d)), path, ["d"], files=2)
    counts = {str(r["d"]): r["count"] for r in spark.read.parquet(path).groupBy("d").count().collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 4}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_row_count_is_observed_while_writing(spark, tmp_path):
    counted, seen = W.with_row_count(spark.range(17))
    counted.write.parquet(str(tmp_path / "n"))
    assert seen.get["rows"] == 17


def test_bronze_reads_prune_to_one_day(spark, tmp_path):
    rows = adapters.trip_updates(spark, "/root/testdata/sf0.001")
    W.write_partitions(rows, str(tmp_path), ["record_type", "dt", "hour"])
    one = R.read_bronze(spark, str(tmp_path), "trip_updates", date(2024, 1, 5))
    assert one.columns == S.TRIP_UPDATES_SCHEMA.names
    assert one.count() == rows.where("dt = '2024-01-05'").count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_csv_binds_by_name(spark, tmp_path):
    path = tmp_path / "trips.txt"
    path.write_text('trip_id,route_id,direction_id,trip_headsign\nT1,R1,0,"Main, St"\n')
    row = R.read_csv_by_name(spark, str(path), S.DIM_COLUMNS["trips"], S.DIM_REQUIRED["trips"]).first()
    assert (row["route_id"], row["trip_id"], row["trip_headsign"]) == ("R1", "T1", "Main, St")
    assert row["direction_id"] == "0" and row["trip_short_name"] is None
    path.write_text("route_id\nR1\n")
    with pytest.raises(ValueError):
        R.read_csv_by_name(spark, str(path), S.DIM_COLUMNS["trips"], S.DIM_REQUIRED["trips"])


def test_static_refresh_loads_only_what_changed(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    (src / "routes.txt").write_text("route_id,route_short_name,route_type\nR1,one,3\n")
    (src / "agency.txt").write_text("agency_id,agency_name\nA,Agency\n")
    (src / "notes.txt").write_text("not wanted\n")

    def refresh(version):
        return {r["name"]: r["status"] for r in
                static.refresh_static(spark, str(src), dst, version).collect()}

    assert refresh("v1") == {"agency": "updated", "routes": "updated"}
    assert refresh("v2") == {"agency": "unchanged", "routes": "unchanged"}
    (src / "routes.txt").write_text("route_id,route_short_name,route_type\nR1,uno,3\n")
    assert refresh("v3") == {"agency": "unchanged", "routes": "updated"}
    assert R.read_dim(spark, dst, "v1", "routes").first()["route_short_name"] == "one"
    assert R.read_dim(spark, dst, "v3", "routes").first()["route_short_name"] == "uno"
    assert R.read_dim(spark, dst, "v2", "routes").first()["route_short_name"] == "one"
    assert [R.dim_version(spark, dst, v, "agency") for v in ("v1", "v2", "v3")] == ["v1"] * 3
    assert refresh("v3") == {"agency": "unchanged", "routes": "unchanged"}
    assert spark.read.parquet(f"{dst}/_manifest").count() == 6
    assert R.dim_version(spark, dst, "v9", "routes") == "v9"


def test_a_file_in_another_order_is_another_file(spark, tmp_path):
    for name, lines in (("a", "1\n2\n3\n"), ("b", "1\n3\n2\n"), ("c", "1\n2\n3\n")):
        (tmp_path / name).write_text(lines)
    a, b, c = (static.content_digest(spark, str(tmp_path / n)) for n in "abc")
    assert a == c != b


def test_predictions_of_a_day_from_nested_folders(spark, tmp_path):
    for where, day, value in (("m/a", "2024-01-05", "12.5"), ("x", "2024-01-05", '"oops"'),
                              ("m/a", "2024-01-06", "1")):
        folder = tmp_path / where / day
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(
            '{"route_id": 7, "stop_id": "s", "trip_id": "t", "service_date": "2024-01-05",'
            f' "predicted_delay_sec": {value}}}\n')
    rows = R.read_predictions(spark, str(tmp_path), "2024-01-05").collect()
    assert sorted((r["predicted_delay_sec"] or 0.0) for r in rows) == [0.0, 12.5]
    assert {r["route_id"] for r in rows} == {"7"} and rows[0]["service_date"] == date(2024, 1, 5)


def test_load_split_fills_and_checks(spark, tmp_path):
    path = str(tmp_path / "split")
    rows = feature_columns(spark.range(10)).withColumns(
        {S.TARGET: F.lit(5), "split": F.lit("train"), "temp_c": F.lit(None).cast("double")}
    )
    W.write_partitions(rows, path, ["split"])
    got = R.load_split(spark, path, "train")
    assert got.count() == 10 and got.first()["temp_c"] == 10.0
    W.write_partitions(rows.drop("temp_c"), str(tmp_path / "short"), ["split"])
    with pytest.raises(KeyError):
        R.load_split(spark, str(tmp_path / "short"), "train")


def test_documents_are_written_per_day(spark, tmp_path):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), "t", "s", 5)],
        "service_date date, trip_id string, stop_id string, observed_delay_sec int")
    for d in ("2024-01-01", "2024-01-02", "2024-01-02"):
        W.write_dq(dq_rules(df, min_rows=1), str(tmp_path / "dq"), d)
    files = sorted((tmp_path / "dq").glob("dt=*/*.json"))
    assert [f.parent.name for f in files] == ["dt=2024-01-01", "dt=2024-01-02"]
    rules = [json.loads(line) for line in files[0].read_text().splitlines()]
    assert len(rules) == 5 and all(r["passed"] for r in rules)
    W.export_csv(df, str(tmp_path / "csv"), files=1)
    (out,) = (tmp_path / "csv").glob("*.csv")
    assert out.read_text().splitlines()[0] == "service_date,trip_id,stop_id,observed_delay_sec"


def test_optional_tables_are_asked_for(spark):
    assert R.table_if_present(spark, "no_such_table") is None
    empty = R.read_or_empty(spark, "/tmp/no/such/path", S.WEATHER_SCHEMA)
    assert empty.count() == 0 and empty.columns == S.WEATHER_SCHEMA.names

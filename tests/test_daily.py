from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.gold import build_features, daily_histograms, historical_priors, priors_of_histograms
from headway.operators.quality import layer_diff
from headway.operators.silver import build_silver, upsert_silver
from headway.plans.daily import Config, backfill, rebuild_gold, run_day
from headway.plans.warehouse import Warehouse
from headway.sinks.tables import write_partitions
from headway.sources.tables import read_features, read_silver

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    """Bronze of a few days whose service dates trail their landing day by one."""
    root = tmp_path_factory.mktemp("lake")
    w = Warehouse(spark, SF)
    rows = w.trip_updates().where("dt BETWEEN '2024-01-01' AND '2024-01-04'")
    # Rows landed before 08:00 belong to the service day before, as a local evening would.
    late = F.date_format(F.date_sub(F.to_date("start_date", "yyyyMMdd"), 1), "yyyyMMdd")
    rows = rows.withColumn("start_date", F.when(F.col("hour") < "08", late).otherwise(F.col("start_date")))
    write_partitions(rows, str(root / "bronze"), ["record_type", "dt", "hour"])
    for name, df in w.dims().items():
        filled = df.select(*[
            F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in S.DIM_COLUMNS[name]])
        filled.write.parquet(str(root / "static" / "version=1" / name))
    cfg = Config(*[str(root / n) for n in ("bronze", "silver", "gold", "dq", "static")], "1",
                 min_rows=30, min_label=0.5, min_cell=1)
    return w, rows, cfg


def test_backfill_rebuilds_gold_for_every_day_it_touches(spark, setup):
    w, rows, cfg = setup
    results = backfill(spark, cfg, date(2024, 1, 4), 4)
    assert [r.status for r in results] == ["succeeded"] * 4
    assert results[1].touched == [date(2024, 1, 1), date(2024, 1, 2)]
    assert results[1].built == results[1].touched
    silver = read_silver(spark, cfg.silver)
    whole = build_silver(rows, **w.dims())
    assert sorted(map(str, silver.collect())) == sorted(map(str, whole.select(*silver.columns).collect()))
    gold = read_features(spark, cfg.gold)
    built = silver.where("service_date >= '2024-01-01'")
    assert layer_diff(built, gold.where("service_date >= '2024-01-01'")).count() == 0
    assert results[-1].gold_rows == gold.where("service_date >= '2024-01-03'").count()
    # A repeated day changes nothing.
    before = sorted(map(str, gold.collect()))
    run_day(spark, cfg, "2024-01-04")
    assert sorted(map(str, read_features(spark, cfg.gold).collect())) == before
    expected = build_features(read_silver(spark, cfg.silver), date(2024, 1, 4), min_count=1)
    got = read_features(spark, cfg.gold).where("service_date = '2024-01-04'").select(*expected.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_failed_gate_keeps_gold_and_leaves_silver(spark, setup, tmp_path):
    _, _, cfg = setup
    strict = replace(cfg, silver=str(tmp_path / "s"), gold=str(tmp_path / "g"), dq=str(tmp_path / "q"),
                     min_rows=10**6)
    result = run_day(spark, strict, "2024-01-02")
    assert result.status == "quarantined"
    assert result.failed[date(2024, 1, 2)] == ["row_count_minimum"]
    assert not (tmp_path / "g").exists()
    assert read_silver(spark, strict.silver).count() > 0
    document = spark.read.json(strict.dq).where("dt = '2024-01-02'")
    assert {r["rule"]: r["passed"] for r in document.collect()}["row_count_minimum"] is False


def test_malformed_dates_are_kept_apart(spark, setup, tmp_path):
    _, rows, cfg = setup
    odd = rows.where("dt = '2024-01-02'")
    bad = odd.where(F.col("hour") == "09")
    write_partitions(
        odd.unionByName(bad.withColumn("start_date", F.lit("2024-13"))),
        str(tmp_path / "bronze"), ["record_type", "dt", "hour"],
    )
    own = replace(cfg, bronze=str(tmp_path / "bronze"), silver=str(tmp_path / "s"), gold=str(tmp_path / "g"),
                  dq=str(tmp_path / "q"))
    result = run_day(spark, own, "2024-01-02")
    assert result.rejected > 0 and date(2024, 1, 2) in result.touched
    rejects = spark.read.parquet(f"{own.silver}_rejects")
    assert rejects.count() == result.rejected
    assert {r["start_date"] for r in rejects.select("start_date").collect()} == {"2024-13"}
    kept = read_silver(spark, own.silver)
    assert kept.where("service_date IS NULL").count() == 0
    with pytest.raises(ValueError, match="service_date"):
        upsert_silver(spark, own.silver, rejects.drop("dt"))
    assert read_silver(spark, own.silver).count() == kept.count()


def test_day_without_bronze_is_quarantined(spark, setup, tmp_path):
    _, _, cfg = setup
    result = run_day(spark, replace(cfg, silver=str(tmp_path / "s")), "2024-03-01")
    assert result.status == "quarantined" and result.touched == []


def test_broken_job_is_not_a_data_failure(spark, setup):
    _, _, cfg = setup
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_day(spark, replace(cfg, bronze="/tmp/no/such/bronze"), "2024-01-02")


def test_kept_histograms_follow_every_run_and_give_the_same_gold(spark, setup, tmp_path):
    _, _, cfg = setup
    own = replace(cfg, silver=str(tmp_path / "s"), gold=str(tmp_path / "g"), dq=str(tmp_path / "q"))
    run_day(spark, own, "2024-01-01")  # a day before histograms are kept: the next run fills it
    kept = replace(own, histograms=str(tmp_path / "h"))
    for d in (2, 3, 4):
        run_day(spark, kept, f"2024-01-0{d}")
        silver = read_silver(spark, own.silver)
        held = spark.read.schema(S.HISTOGRAM_SCHEMA).parquet(kept.histograms)
        assert sorted(map(str, held.collect())) == sorted(map(str, daily_histograms(silver).collect()))
        for run in (date(2024, 1, d), date(2024, 1, d + 1)):
            assert sorted(map(str, priors_of_histograms(held, run, min_count=1).collect())) == sorted(
                map(str, historical_priors(silver, run, min_count=1).collect()))
    columns = S.TRAINING_FEATURES_SCHEMA.names
    got = read_features(spark, kept.gold).where("service_date = '2024-01-04'").select(*columns)
    expected = build_features(read_silver(spark, own.silver), date(2024, 1, 4), min_count=1).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_rebuild_in_one_plan_equals_the_day_by_day_runs(spark, setup, tmp_path):
    _, _, cfg = setup
    own = replace(cfg, silver=str(tmp_path / "s"), gold=str(tmp_path / "g"), dq=str(tmp_path / "q"))
    backfill(spark, own, date(2024, 1, 4), 4)
    again = replace(own, gold=str(tmp_path / "g2"), dq=str(tmp_path / "q2"))
    rows = rebuild_gold(spark, again, date(2024, 1, 4), 4)
    columns = S.TRAINING_FEATURES_SCHEMA.names
    both = [sorted(map(str, read_features(spark, c.gold).where("service_date >= '2024-01-01'").select(*columns).collect()))
            for c in (own, again)]
    assert rows == len(both[1]) > 0
    # Priors of day by day runs stand as of their run; only the tail's last correction may differ.
    assert len(both[0]) == len(both[1])
    last = [sorted(map(str, read_features(spark, c.gold).where("service_date = '2024-01-04'").select(*columns).collect()))
            for c in (own, again)]
    assert last[0] == last[1]
    # One date fails: its gold and the other dates' stay as they were, its document says why.
    sizes = {r["service_date"]: r["count"] for r in read_silver(spark, own.silver).groupBy("service_date").count().collect()}
    small = min((d for d in sizes if d >= date(2024, 1, 1)), key=sizes.get)
    strict = replace(again, gold=str(tmp_path / "g3"), dq=str(tmp_path / "q3"), min_rows=sizes[small] + 1)
    rebuild_gold(spark, strict, date(2024, 1, 4), 4)
    built = {r[0] for r in read_features(spark, strict.gold).select("service_date").distinct().collect()}
    assert small not in built and built == {d for d in sizes if d >= date(2024, 1, 1) and sizes[d] > sizes[small]}
    failed = spark.read.json(strict.dq).where(f"dt = '{small}' AND NOT passed").collect()
    assert [r["rule"] for r in failed] == ["row_count_minimum"]

"""One day end to end: bronze, silver, the gate, gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.dates import last_days, resolve_run_date
from headway.operators.gold import build_features, daily_histograms, day
from headway.operators.quality import dq_rules, passing_dates
from headway.operators.silver import build_silver, upsert_silver
from headway.session import stage, use_utc
from headway.sinks.tables import reject_undated, with_row_count, write_dq, write_json, write_partitions
from headway.sources.tables import read_bronze, read_dim, read_or_empty, read_silver


@dataclass(frozen=True)
class Config:
    """Where the tables live, and the limits of the gate.

    With ``histograms`` named, days are reduced to histograms once, and priors read those.
    """

    bronze: str
    silver: str
    gold: str
    dq: str
    static: str
    static_version: str
    weather: str | None = None
    rejects: str | None = None
    histograms: str | None = None
    zone: str = "UTC"
    min_rows: int = S.DQ_MIN_ROWS
    min_label: float = S.DQ_MIN_LABEL
    min_unique: float = S.DQ_MIN_UNIQUE
    lookback: int = S.LOOKBACK_DAYS
    min_cell: int = S.MIN_CELL_ROWS


@dataclass(frozen=True)
class RunResult:
    run_date: date
    status: str
    touched: list[date] = field(default_factory=list)
    built: list[date] = field(default_factory=list)
    failed: dict[date, list[str]] = field(default_factory=dict)
    gold_rows: int = 0
    rejected: int = 0


def build_day(spark: SparkSession, cfg: Config, run_date: date) -> DataFrame:
    """Silver rows of one landing day."""
    dims = {
        name: read_dim(spark, cfg.static, cfg.static_version, name)
        for name in ("stop_times", "stops", "trips", "routes")
    }
    updates = read_bronze(spark, cfg.bronze, "trip_updates", run_date)
    return build_silver(updates, **dims, zone=cfg.zone, leads=True)


def gate(spark: SparkSession, cfg: Config, run_date: date, touched: Sequence[date]
         ) -> dict[date, list[str]]:
    """Failed rules per date, and the day's document written for the failed ones too."""
    limits = (cfg.min_rows, cfg.min_label, cfg.min_unique)
    silver = read_silver(spark, cfg.silver, sorted({*touched, run_date}))
    of_day = dq_rules(day(silver, run_date), *limits).withColumn("service_date", F.lit(run_date))
    others = dq_rules(
        silver.where(F.col("service_date") != F.lit(run_date)), *limits, by=["service_date"]
    )
    rules = of_day.unionByName(others).persist()  # five rows per touched date
    try:
        failed: dict[date, list[str]] = {}
        for row in rules.where(~F.col("passed")).orderBy("service_date", "rule").collect():
            failed.setdefault(row["service_date"], []).append(row["rule"])
        write_dq(rules.where(F.col("service_date") == F.lit(run_date)), cfg.dq, str(run_date))
        return failed
    finally:
        rules.unpersist()


def keep_histograms(spark: SparkSession, cfg: Config, touched: Sequence[date]) -> DataFrame:
    """Daily histograms with the touched dates made anew, and those of days not kept so far.

    A run reads the silver of its touched dates only; the first one fills the history.
    """
    held = read_or_empty(spark, cfg.histograms, S.HISTOGRAM_SCHEMA)
    from_day = min(touched) - timedelta(days=cfg.lookback)
    dates = read_silver(spark, cfg.silver).select("service_date").where(
        F.col("service_date") >= F.lit(from_day)
    ).distinct()
    # One value per day.
    unknown = [r[0] for r in dates.join(held.select("service_date").distinct(), "service_date", "left_anti").collect()]
    anew = read_silver(spark, cfg.silver, sorted({*touched, *unknown}))
    write_partitions(daily_histograms(anew), cfg.histograms, ["service_date"])
    return spark.read.schema(S.HISTOGRAM_SCHEMA).parquet(cfg.histograms)


def run_day(spark: SparkSession, cfg: Config, run_date: str | date,
            weather: DataFrame | None = None) -> RunResult:
    """Upsert a landing day into silver, check it, and build gold.

    The tail of a service day lands on the next day and corrects it, so gold is rebuilt
    for every service date the upsert touched, as far as it passes the gate. If the run
    date itself fails, no gold is written and the day stays in silver to look at. Errors
    are raised: a broken job is not a data quality failure.
    """
    use_utc(spark)
    run_date = resolve_run_date(run_date)
    staged = stage(build_day(spark, cfg, run_date), "day")
    rejected = reject_undated(staged, cfg.rejects or f"{cfg.silver}_rejects", dt=str(run_date))
    touched = upsert_silver(spark, cfg.silver, staged.where(F.col("service_date").isNotNull()))
    if not touched:
        return RunResult(
            run_date, "quarantined", failed={run_date: ["row_count_minimum"]}, rejected=rejected
        )
    histograms = keep_histograms(spark, cfg, touched) if cfg.histograms else None
    failed = gate(spark, cfg, run_date, touched)
    good = [d for d in touched if d not in failed]
    if run_date in failed or not good:
        return RunResult(run_date, "quarantined", touched, failed=failed, rejected=rejected)
    silver = read_silver(spark, cfg.silver)
    features = build_features(
        silver, good, weather, cfg.zone, cfg.lookback, cfg.min_cell, histograms=histograms
    )
    counted, seen = with_row_count(features, "gold")
    write_partitions(counted, cfg.gold, ["service_date"])
    return RunResult(run_date, "succeeded", touched, good, failed, seen.get["rows"], rejected)


def backfill(spark: SparkSession, cfg: Config, end: date, days: int,
             weather: DataFrame | None = None) -> list[RunResult]:
    """Replay days oldest first; each day's priors need the days before it in silver."""
    return [run_day(spark, cfg, d, weather) for d in last_days(end, days)]


def gated_features(silver: DataFrame, first: date, last: date, limits: Sequence[float],
                   weather: DataFrame | None = None, zone: str = "UTC",
                   lookback: int = S.LOOKBACK_DAYS, min_cell: int = S.MIN_CELL_ROWS
                   ) -> tuple[DataFrame, DataFrame]:
    """Rules of every date from ``first`` to ``last``, and gold of the dates that pass: one plan.

    Each date is judged by itself and its rows meet the passing dates in a semi-join; the
    driver never learns which. A failed date still counts in later dates' priors, as it
    stays in silver.
    """
    known = silver.where(
        (F.col("service_date") <= F.lit(last)) & (F.col("service_date") >= F.date_sub(F.lit(first), lookback))
    )
    asked = known.where(F.col("service_date") >= F.lit(first))
    rules = dq_rules(asked, *limits, by=["service_date"])
    return rules, build_features(known, passing_dates(rules).where(F.col("service_date") >= F.lit(first)),
                                 weather, zone, lookback, min_cell)


def rebuild_gold(spark: SparkSession, cfg: Config, end: date, days: int,
                 weather: DataFrame | None = None) -> int:
    """Gold of the last ``days`` dates of stored silver in one pass; returns the rows written.

    Every date has its document written; dates that fail keep the gold they had. Unlike
    ``backfill`` it reads no bronze, and each date passes or fails by itself.
    """
    use_utc(spark)
    dates = last_days(end, days)
    silver = read_silver(spark, cfg.silver)
    limits = (cfg.min_rows, cfg.min_label, cfg.min_unique)
    rules, features = gated_features(
        silver, dates[0], dates[-1], limits, weather, cfg.zone, cfg.lookback, cfg.min_cell
    )
    judged = rules.select("*", F.col("service_date").cast("string").alias("dt")).drop("service_date")
    write_json(judged, cfg.dq, ["dt"])
    counted, seen = with_row_count(features, "gold")
    write_partitions(counted, cfg.gold, ["service_date"])
    return seen.get["rows"]

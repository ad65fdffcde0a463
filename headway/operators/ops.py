"""Operating the pipeline: ingest gaps, degradation, missing runs, cost."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import schemas as S


def day_spine(df: DataFrame, start: date, end: date, name: str = "day") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive."""
    spark = df.sparkSession
    return spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name)
    )


def ingest_windows(df: DataFrame, start: datetime, end: datetime, width: str = S.STALL_WIDTH,
                   min_rows: int = S.STALL_ROWS, ts: Column | None = None) -> DataFrame:
    """Rows landed per tumbling window; a window without any rows is stalled too.

    ``end`` is exclusive; values without a zone are UTC.
    """
    start, end = (t if t.tzinfo else t.replace(tzinfo=UTC) for t in (start, end))
    number, unit = width.split()
    step = int(number) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]
    at = ts if ts is not None else F.timestamp_seconds("ingest_ts")
    first = int(start.timestamp()) // step * step
    spine = df.sparkSession.range(first, int(end.timestamp()), step).select(
        F.col("id").alias("window_start")
    )
    seen = df.groupBy(F.window(at, width).alias("w")).agg(F.count(F.lit(1)).alias("_rows"))
    landed = seen.select(F.unix_timestamp("w.start").alias("window_start"), "_rows")
    rows = F.coalesce("_rows", F.lit(0))
    return spine.join(landed, "window_start", "left").select(
        "window_start", rows.alias("rows"), (rows < min_rows).alias("stalled")
    )


def degraded(metrics: DataFrame, limit: float = S.DEGRADED_RATIO, periods: int = 2,
             value: str = "mae_ratio_vs_persistence", by: str = "service_date") -> DataFrame:
    """State of the degradation alarm per day: ``periods`` days in a row above ``limit``.

    A day without a value is unknown, neither a breach nor a pass. Each day is handed to
    the days it is looked at from, so no window over all days is needed.
    """
    seen = F.explode(F.sequence(F.col(by), F.date_add(by, periods - 1)))
    spread = metrics.select(seen.alias("day"), F.col(value).alias("_v"))
    breaches = F.count_if(F.col("_v") > limit)
    passes = F.count_if(F.col("_v") <= limit)
    status = (
        F.when(passes > 0, "ok").when(breaches == periods, "degraded").otherwise("unknown")
    )
    return (
        spread.groupBy("day").agg(breaches.alias("breaches"), status.alias("status"))
        .join(metrics.select(F.col(by).alias("day")).distinct(), "day", "left_semi")
    )


def metric_summary(points: DataFrame, start: date | None = None, end: date | None = None,
                   at: str = "day") -> DataFrame:
    """Total, maximum and minimum per metric over a lookback; absent points are not zeros."""
    rows = points
    if start is not None:
        rows = rows.where(F.col(at) >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col(at) < F.lit(end))
    return rows.groupBy("metric").agg(
        F.count("value").alias("points"),
        F.sum("value").alias("total"),
        F.max("value").alias("highest"),
        F.min("value").alias("lowest"),
    )


def missing_runs(runs: DataFrame, start: date, end: date) -> DataFrame:
    """Days from ``start`` to ``end`` without any run; a failed run is not missing."""
    return day_spine(runs, start, end).join(runs.select("day"), "day", "left_anti")


def run_status(runs: DataFrame, start: date, end: date) -> DataFrame:
    """One row per expected day: missing, failed or ok, with the longest duration."""
    minutes = (F.unix_timestamp("ended") - F.unix_timestamp("started")) / 60
    per_day = runs.groupBy("day").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.max(minutes).alias("minutes"),
    )
    status = (
        F.when(F.col("runs").isNull(), "missing").when(F.col("failed") > 0, "failed").otherwise("ok")
    )
    return day_spine(runs, start, end).join(per_day, "day", "left").withColumn("verdict", status)


# --- cost -----------------------------------------------------------------------


def cost_daily(items: DataFrame, as_of: date | None = None, days: int | None = None,
               project: str | None = None, floor: float = S.MIN_LINE_COST) -> DataFrame:
    """Gross usage per day and service; ``as_of`` itself is partial and left out."""
    usage = items.where(F.col("record_type") == "Usage")
    if project is not None:
        usage = usage.where(F.col("project") == project)
    if as_of is not None:
        usage = usage.where(F.col("day") < F.lit(as_of))
        if days is not None:
            usage = usage.where(F.col("day") >= F.date_sub(F.lit(as_of), days))
    per_service = usage.groupBy("day", "service").agg(F.sum("amount").alias("amount"))
    return per_service.where(F.col("amount") >= floor)


def cost_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy("day").agg(F.sum("amount").alias("total"))


def cost_delta(daily: DataFrame, threshold: float = S.SERVICE_MOVE) -> DataFrame:
    """Change of every service against the day before; a service absent on one side is zero.

    Covers every day that has a successor or predecessor in the data, so the newest day's
    movers are one filter away.
    """
    days = daily.select("day").distinct()
    before = daily.select(
        F.date_add("day", 1).alias("day"), "service", F.col("amount").alias("before")
    )
    follows = days.join(days.select(F.date_add("day", 1).alias("day")), "day", "left_semi")
    both = daily.join(before, ["day", "service"], "full").join(follows, "day", "left_semi")
    now, then = F.coalesce("amount", F.lit(0.0)), F.coalesce("before", F.lit(0.0))
    return both.select(
        "day",
        "service",
        then.alias("before"),
        now.alias("now"),
        (now - then).alias("delta"),
        (F.abs(now - then) >= threshold).alias("moved"),
    )


def cost_movers(delta: DataFrame, k: int | None = None) -> DataFrame:
    """The services of ``cost_delta`` that moved, ranked by absolute change within their day."""
    rank = Window.partitionBy("day").orderBy(F.abs("delta").desc(), "service")
    ranked = delta.where("moved").drop("moved").withColumn("rank", F.row_number().over(rank))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def top_services(daily: DataFrame, d: date | None = None, k: int = 3) -> DataFrame:
    """The ``k`` most expensive services of each day."""
    rows = daily if d is None else daily.where(F.col("day") == F.lit(d))
    rank = Window.partitionBy("day").orderBy(F.col("amount").desc(), "service")
    return rows.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)


def cost_run_rate(daily: DataFrame, as_of: date | None = None) -> DataFrame:
    """Per day: its total, the day before, 3-day median and mean, and month projections.

    The projected month is ``as_of``'s, by default the month of the day itself. The window
    runs over daily totals, one row per day of history.
    """
    by_day = Window.orderBy("day")
    last3 = by_day.rowsBetween(-2, 0)
    month_of = F.lit(as_of) if as_of is not None else F.col("day")
    month_days = F.dayofmonth(F.last_day(month_of))
    return (
        cost_totals(daily)
        .withColumns(
            {
                "prior_total": F.lag("total").over(by_day),
                "median_rate": F.percentile("total", 0.5).over(last3),
                "mean_rate": F.avg("total").over(last3),
                "days_in_month": month_days,
            }
        )
        .withColumns(
            {
                "projected_month": F.col("median_rate") * F.col("days_in_month"),
                "projected_from_latest": F.col("total") * F.col("days_in_month"),
            }
        )
    )


def cost_verdict(rate: DataFrame, daily_max: float = S.DAILY_COST_LIMIT,
                 monthly_max: float = S.MONTHLY_COST_LIMIT) -> DataFrame:
    """Breached now, breached but resolved, or over only because of a stale window.

    The first day has no predecessor and no verdict.
    """
    daily_over = F.col("total") > daily_max
    prior_over = F.col("prior_total") > daily_max
    month_over = F.col("projected_month") > monthly_max
    live_trend = F.col("projected_from_latest") > monthly_max
    daily_status = (
        F.when(daily_over, "breached").when(prior_over, "resolved").otherwise("ok")
    )
    month_status = (
        F.when(month_over & live_trend, "breached").when(month_over, "stale_window")
        .otherwise("ok")
    )
    return rate.where(F.col("prior_total").isNotNull()).select(
        "day",
        "total",
        "median_rate",
        "projected_month",
        daily_status.alias("daily_status"),
        month_status.alias("month_status"),
        (daily_over | (month_over & live_trend)).alias("breached"),
        (F.col("mean_rate") > 2 * F.col("median_rate")).alias("one_day_dominates"),
    )


def cost_drivers(daily: DataFrame, d: date | None = None) -> DataFrame:
    """Each service's share of its day's total."""
    rows = daily if d is None else daily.where(F.col("day") == F.lit(d))
    total = F.sum("amount").over(Window.partitionBy("day"))
    return rows.select("day", "service", "amount", (F.col("amount") / total).alias("share"))


def credits(items: DataFrame, d: date | None = None) -> DataFrame:
    """Credits applied per day, as a positive amount."""
    rows = items.where(F.col("record_type") == "Credit")
    if d is not None:
        rows = rows.where(F.col("day") == F.lit(d))
    return rows.groupBy("day").agg(F.abs(F.sum("amount")).alias("credited"))

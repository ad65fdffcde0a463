"""Profile and baseline queries over silver and gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import delay_bucket
from headway.operators.gold import labelled, since
from headway.operators.ranges import discrete_quantiles, value_counts

def delay() -> Column:
    return F.col(S.TARGET)


def abs_error(guess: Column) -> Column:
    """Absolute error of a guess; a missing guess counts as the timetable, zero delay."""
    return F.abs(delay() - F.coalesce(guess, F.lit(0)))


def baselines(df: DataFrame, as_of: date | None = None, days: int = 14) -> DataFrame:
    """What timetable, persistence and (on gold) the prior achieve, in seconds.

    ``n`` counts every row; the means skip rows without a label.
    """
    rows = df if as_of is None else since(df, as_of, days)
    columns = [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(delay())).alias("mae_schedule"),
        F.avg(abs_error(F.col("delay_t_minus_15"))).alias("mae_persistence"),
    ]
    if "hist_median_delay" in df.columns:
        columns.append(F.avg(abs_error(F.col("hist_median_delay"))).alias("mae_historical"))
    return rows.agg(*columns)


def silver_baselines(silver: DataFrame) -> DataFrame:
    """The published baseline table: labelled rows only, one decimal."""
    out = baselines(labelled(silver))
    return out.select("n", *[F.round(c, 1).alias(c) for c in out.columns if c != "n"])


def historical_baseline(gold: DataFrame) -> DataFrame:
    return labelled(gold).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("hist_median_delay").alias("with_prior"),
        F.round(F.avg(abs_error(F.col("hist_median_delay"))), 1).alias("mae_historical"),
    )


def baseline_gain(silver: DataFrame, gate: float = S.MODEL_GATE) -> DataFrame:
    """Persistence gain over the timetable, and the error a model has to reach."""
    schedule, persistence = F.col("mae_schedule"), F.col("mae_persistence")
    gain = F.when(schedule == 0, 0.0).otherwise((schedule - persistence) / schedule * 100)
    return silver_baselines(silver).withColumns(
        {"persistence_gain_pct": gain, "gate_sec": persistence * gate}
    )


def delay_distribution(silver: DataFrame) -> DataFrame:
    """Arrivals per delay bucket; the buckets are finer on the late side."""
    return (
        labelled(silver).groupBy(delay_bucket(delay()).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("bucket")
    )


def distribution_share(silver: DataFrame) -> DataFrame:
    """Percentage per bucket, and the early and late shares of all arrivals."""
    everything = Window.partitionBy()  # at most seven rows
    n, total = F.col("n"), F.sum("n").over(everything)

    def share(word: str) -> Column:
        return F.sum(F.when(F.col("bucket").contains(word), n).otherwise(0)).over(
            everything) * 100.0 / total

    return delay_distribution(silver).select(
        "bucket",
        F.regexp_replace("bucket", r"^\d\.\s*", "").alias("label"),
        "n",
        (n * 100.0 / total).alias("pct"),
        share("early").alias("early_pct"),
        share("late").alias("late_pct"),
    )


def hour_profile(silver: DataFrame, offset: int = 0) -> DataFrame:
    """Volume, mean and 90th percentile per hour, in hours shifted by ``offset``."""
    rows = labelled(silver)
    weighted = F.sum(F.col(S.TARGET).cast("double") * F.col("n"))
    cells = discrete_quantiles(
        value_counts(rows, ["hour_of_day"], S.TARGET), ["hour_of_day"], S.TARGET,
        {"p90": 0.9}, extra=[weighted.alias("_sum")],
    )
    hour = F.pmod(F.col("hour_of_day") + offset, F.lit(24)).alias("hour_of_day")
    return cells.select(
        hour,
        F.col("total").alias("events"),
        F.round(F.col("_sum") / F.col("total"), 1).alias("avg_delay"),
        F.round(F.col("p90").cast("double"), 1).alias("p90_delay"),
    ).orderBy("hour_of_day")


def worst_hour(profile: DataFrame) -> DataFrame:
    """The hour with the highest 90th percentile; the earliest such hour on ties."""
    rank = F.struct("p90_delay", (-F.col("hour_of_day")).alias("_early"))
    return profile.agg(
        F.max_by("hour_of_day", rank).alias("hour_of_day"),
        F.max("p90_delay").alias("p90_delay"),
    )

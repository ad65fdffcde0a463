"""Predictions against outcomes, and model evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import safe_ratio, unpivot
from headway.operators.ranges import interpolated_quantile

# The published names of the five metric points.
METRIC_POINTS = {
    "model_mae": "ModelMae",
    "persistence_mae": "PersistenceMae",
    "schedule_mae": "ScheduleMae",
    "mae_ratio_vs_persistence": "ModelMaeRatioVsPersistence",
    "n": "PredictionsScored",
}


def observed() -> Column:
    return F.col(S.TARGET).cast("double")


def predicted() -> Column:
    return F.col("predicted_delay_sec").cast("double")


def _errors(persistence: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(observed() - predicted())).alias("model_mae"),
        F.avg(F.abs(observed() - persistence)).alias("persistence_mae"),
        F.avg(F.abs(observed())).alias("schedule_mae"),
        F.sqrt(F.avg(F.pow(observed() - predicted(), F.lit(2)))).alias("model_rmse"),
    ]


def match_outcomes(predictions: DataFrame, actuals: DataFrame,
                   latest_only: bool = False) -> DataFrame:
    """Predictions joined to labelled arrivals. Repeats count unless ``latest_only``."""
    if latest_only:
        order = [c for c in ("captured_at", "predicted_delay_sec") if c in predictions.columns]
        rest = [c for c in predictions.columns if c not in S.SILVER_KEY and c not in order]
        predictions = (
            predictions.groupBy(*S.SILVER_KEY)
            .agg(F.max(F.struct(*order, *rest)).alias("_p"))
            .select(*S.SILVER_KEY, "_p.*")
        )
    outcomes = actuals.where(F.col(S.TARGET).isNotNull()).select(*S.SILVER_KEY, S.TARGET)
    return predictions.join(outcomes, list(S.SILVER_KEY))


def backtest(predictions: DataFrame, actuals: DataFrame, latest_only: bool = False,
             by: Sequence[str] = ()) -> DataFrame:
    """Model, persistence and timetable error over matched rows; no matches, no row."""
    matched = match_outcomes(predictions, actuals, latest_only)
    metrics = matched.groupBy(*by).agg(
        *_errors(F.coalesce(F.col("delay_t_minus_15").cast("double"), F.lit(0.0)))
    )
    ratio = safe_ratio(F.col("model_mae"), F.col("persistence_mae"))
    rounded = [
        F.round(c, 3).alias(c)
        for c in ("model_mae", "persistence_mae", "schedule_mae", "model_rmse")
    ]
    return metrics.where(F.col("n") > 0).select(
        *by, "n", *rounded, F.round(ratio, 4).alias("mae_ratio_vs_persistence")
    )


def metric_points(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Backtest metrics as named points, one per row."""
    return unpivot(
        metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in METRIC_POINTS]),
        keys, METRIC_POINTS, "metric", "value",
    )


def evaluation_report(scored: DataFrame, gate: float = S.MODEL_GATE) -> DataFrame:
    """Errors of a scored test set against three baselines on the same rows, and the gate.

    Baselines use filled features, so a missing snapshot or prior means zero delay.
    """
    rows = scored.where(F.col(S.TARGET).isNotNull())
    error = F.abs(observed() - predicted())
    filled = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0))
              for n in ("delay_t_minus_15", "hist_median_delay")}
    metrics = rows.agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(F.pow(observed() - predicted(), F.lit(2)))).alias("rmse"),
        F.avg(F.abs(observed() - filled["delay_t_minus_15"])).alias("persistence_mae"),
        F.avg(F.abs(observed())).alias("schedule_mae"),
        F.avg(F.abs(observed() - filled["hist_median_delay"])).alias("historical_mae"),
        F.count(F.lit(1)).alias("n_test"),
    )
    p90 = interpolated_quantile(
        rows.select(error.alias("_error")), [], "_error", 0.9, "p90_abs_error"
    )
    ratio = safe_ratio(F.col("mae"), F.col("persistence_mae"))
    # One row on either side.
    one = F.lit(1).alias("_one")
    return (
        metrics.select("*", one).join(p90.select("*", one), "_one").drop("_one")
        .withColumns(
            {
                "mae_ratio_vs_persistence": ratio,
                "mae_ratio_vs_schedule": safe_ratio(F.col("mae"), F.col("schedule_mae")),
                "passes_gate": F.coalesce(ratio <= gate, F.lit(False)),
            }
        )
    )


def time_split(df: DataFrame, as_of: date | None = None, val_days: int = 7,
               test_days: int = 7) -> DataFrame:
    """Add ``split`` by date: the newest days test, the ones before validate, never random."""
    if as_of is None:
        as_of = df.agg(F.max("service_date")).first()[0]
    age = F.datediff(F.lit(as_of), F.col("service_date"))
    split = (
        F.when(age >= val_days + test_days, "train")
        .when(age >= test_days, "validation")
        .otherwise("test")
    )
    return df.withColumn("split", split)

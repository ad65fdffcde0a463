"""Delay model: boosted trees on the feature contract, and batch scoring."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import feature_value, fill_rate
from headway.models.boosting import Boosted, TrainParams, boost
from headway.operators.live import request_features

__all__ = ["Boosted", "TrainParams", "predict", "score", "train"]


def _features(df: DataFrame) -> Column:
    """The filled feature vector of a row, in the contract's order."""
    have = set(df.columns)
    return F.array(*[feature_value(n, F.col(n) if n in have else F.lit(None)) for n in S.FEATURE_NAMES])


def _labelled(df: DataFrame, held: bool) -> DataFrame:
    rows = df.where(F.col(S.TARGET).isNotNull())
    return rows.select(
        _features(df).alias("features"), F.col(S.TARGET).cast("double").alias("y"), F.lit(held).alias("held")
    )


def train(df: DataFrame, params: TrainParams = TrainParams(),
          validation: DataFrame | None = None) -> Boosted:
    """Fit on the rows with a label. With ``validation``, stop once it no longer gains by more
    trees, and keep as many as do best on it."""
    rows = _labelled(df, False)
    return boost(rows if validation is None else rows.union(_labelled(validation, True)), params)


def predict(df: DataFrame, model: Boosted) -> DataFrame:
    """Add ``predicted_delay_sec``; the features as given stay as they are."""

    @F.pandas_udf("double")
    def delay(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for features in batches:
            yield pd.Series(model.predict(np.stack(features.to_numpy())) if len(features) else [], dtype=float)

    return df.withColumn("predicted_delay_sec", delay(_features(df)))


def score(requests: DataFrame, stop_state: DataFrame, route_state: DataFrame, priors: DataFrame,
          model: Boosted, now: datetime | Column, zone: str = "UTC") -> DataFrame:
    """Score (route_id, stop_id) requests from live state.

    The trip is the one that live state last saw at the stop, and the service date is
    ``now``'s, so that the rows can be captured and matched with outcomes later.
    """
    source = request_features(requests, stop_state, route_state, priors, now, zone)
    rate = F.round(fill_rate(source), 3)
    return predict(source.withColumn("feature_fill_rate", rate), model)

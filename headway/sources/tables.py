"""Readers. Every schema is declared; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas as S
from headway.functions.columns import feature_columns

BRONZE = {
    "trip_updates": S.TRIP_UPDATES_SCHEMA,
    "vehicle_positions": S.VEHICLE_POSITIONS_SCHEMA,
}
#: What each refresh of the static files saw, and the version whose folder holds the file.
MANIFEST_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "digest", "version", "held_in")]
    + [T.StructField("loaded_at", T.TimestampType())]
)
#: Folders between the root of captured predictions and a day's folder, at most.
CAPTURE_DEPTH = 3


def read_bronze(spark: SparkSession, root: str, feed: str,
                dt: str | date | Sequence[str | date] | None = None) -> DataFrame:
    """Landed rows of one feed, for one landing day, several or all, in one scan of their partitions."""
    schema = BRONZE[feed]
    rows = spark.read.schema(schema).parquet(root).where(F.col("record_type") == feed)
    if dt is not None:
        days = [dt] if isinstance(dt, str | date) else dt
        rows = rows.where(F.col("dt").isin([str(day) for day in days]))
    return rows.select(*schema.names)


def read_silver(spark: SparkSession, path: str, dates: Sequence[date] | None = None) -> DataFrame:
    rows = spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path)
    if dates is not None:
        rows = rows.where(F.col("service_date").isin(list(dates)))
    return rows.select(*S.STOP_EVENTS_SCHEMA.names)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.TRAINING_FEATURES_SCHEMA).parquet(path)


def read_weather(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    reader = spark.read.schema(S.WEATHER_SCHEMA).format(format)
    return (reader.option("header", "true") if format == "csv" else reader).load(path)


def table_if_present(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or None: optional enrichment is asked for, not guarded by try."""
    return spark.table(name) if spark.catalog.tableExists(name) else None


def read_csv_by_name(spark: SparkSession, path: str, columns: Sequence[str],
                     required: Sequence[str] = ()) -> DataFrame:
    """Headered CSV as text columns bound by name.

    Spark binds a declared CSV schema by position, so the header is read instead: an
    optional column that is missing becomes NULL and cannot shift its neighbours.
    """
    raw = (
        spark.read.option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    )
    by_name = {c.strip().lstrip("﻿"): c for c in raw.columns}
    missing = [c for c in required if c not in by_name]
    if missing:
        raise ValueError(f"{path} lacks required columns {missing}")
    return raw.select(
        *[
            F.col(f"`{by_name[c]}`").alias(c) if c in by_name
            else F.lit(None).cast("string").alias(c)
            for c in columns
        ]
    )


def dim_version(spark: SparkSession, root: str, version: str, name: str) -> str:
    """The version whose folder holds ``name`` as of ``version``.

    A refresh writes changed files only, so it is the newest load of the file not after the
    last refresh of ``version``. Without a manifest, or for a version it does not
    know, the files are taken to be in the version's own folder.
    """
    manifest = read_or_empty(spark, f"{root}/_manifest", MANIFEST_SCHEMA)
    until = manifest.where(F.col("version") == version).agg(F.max("loaded_at").alias("until"))
    found = (
        manifest.where(F.col("name") == name).join(until, F.col("loaded_at") <= F.col("until"))
        .agg(F.max_by(F.coalesce("held_in", "version"), "loaded_at")).first()[0]
    )
    return found or version


def read_dim(spark: SparkSession, root: str, version: str, name: str, format: str = "parquet"
             ) -> DataFrame:
    """A static dimension of one version: refreshed Parquet, or the CSV as published."""
    columns = S.DIM_COLUMNS[name]
    path = f"{root}/version={dim_version(spark, root, version, name)}/{name}"
    if format == "csv":
        return read_csv_by_name(spark, path, columns, S.DIM_REQUIRED[name])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).parquet(path)


def read_predictions(spark: SparkSession, root: str, run_date: str | date) -> DataFrame:
    """Captured predictions of a day's folder, ``root`` or any folder of it before the day.

    Only the day's folders are listed, up to ``CAPTURE_DEPTH`` folders below ``root``; captures
    that stand there twice count twice. A day without folder has no rows.
    """
    levels = [f"{root}{'/*' * depth}/{run_date}" for depth in range(CAPTURE_DEPTH + 1)]
    reader = spark.read.schema(S.PREDICTIONS_SCHEMA).option("recursiveFileLookup", "true")
    parts = [rows for path in levels if (rows := _read_if_found(reader, path)) is not None]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], S.PREDICTIONS_SCHEMA)
    return rows.select(
        "route_id",
        "stop_id",
        "trip_id",
        F.col("service_date").try_cast("date").alias("service_date"),
        F.col("predicted_delay_sec").try_cast("double").alias("predicted_delay_sec"),
        F.col("delay_t_minus_15").try_cast("double").alias("delay_t_minus_15"),
    )


def _read_if_found(reader: DataFrameReader, path: str) -> DataFrame | None:
    try:
        return reader.json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_split(spark: SparkSession, root: str, split: str, keep: Sequence[str] = ()) -> DataFrame:
    """Filled feature vectors and target of the labelled rows of one split."""
    rows = spark.read.parquet(root).where(F.col("split") == split)
    missing = [c for c in (*S.FEATURE_NAMES, S.TARGET) if c not in rows.columns]
    if missing:
        raise KeyError(f"split {split} lacks columns {missing}")
    rows = rows.where(F.col(S.TARGET).isNotNull())
    return feature_columns(rows, (*keep, S.TARGET))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""Nested feed messages to rows, and rows packed into stream records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schemas as S
from headway.functions.columns import blank_to_null, partition_key


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _text(path: str) -> Column:
    return blank_to_null(F.col(path))


def flatten_trip_updates(feed: DataFrame) -> DataFrame:
    """One row per predicted stop arrival; unset fields are NULL, never zero.

    ``feed`` has the nested message columns and ``ingest_ts``. Only the trip's schedule
    relationship falls back to its wire default, zero.
    """
    updates = (
        feed.select("header", "ingest_ts", F.explode("entity").alias("e"))
        .where(F.col("e.trip_update").isNotNull())
        .select("header", "ingest_ts", F.col("e.trip_update").alias("u"))
        .select("header", "ingest_ts", "u", F.explode("u.stop_time_update").alias("s"))
    )
    relationship = F.coalesce(F.col("u.trip.schedule_relationship"), F.lit(0))
    rows = updates.select(
        F.lit("trip_updates").alias("record_type"),
        F.col("header.timestamp").alias("feed_timestamp"),
        "ingest_ts",
        _text("u.trip.trip_id").alias("trip_id"),
        _text("u.trip.route_id").alias("route_id"),
        F.col("u.trip.direction_id").alias("direction_id"),
        _text("u.trip.start_date").alias("start_date"),
        relationship.alias("schedule_relationship"),
        _text("u.vehicle.id").alias("vehicle_id"),
        _text("s.stop_id").alias("stop_id"),
        F.col("s.stop_sequence").alias("stop_sequence"),
        F.col("s.arrival.time").alias("arrival_time"),
        F.col("s.arrival.delay").alias("arrival_delay"),
        F.col("s.departure.time").alias("departure_time"),
        F.col("s.departure.delay").alias("departure_delay"),
    )
    return _typed(rows, S.TRIP_UPDATES_ROW)


def flatten_vehicle_positions(feed: DataFrame) -> DataFrame:
    """One row per vehicle sighting; position and clock fall back to their wire defaults."""
    sightings = (
        feed.select("header", "ingest_ts", F.explode("entity").alias("e"))
        .where(F.col("e.vehicle").isNotNull())
        .select("header", "ingest_ts", F.col("e.vehicle").alias("v"))
    )

    def wire_default(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(0))

    rows = sightings.select(
        F.lit("vehicle_positions").alias("record_type"),
        F.col("header.timestamp").alias("feed_timestamp"),
        "ingest_ts",
        _text("v.vehicle.id").alias("vehicle_id"),
        _text("v.trip.trip_id").alias("trip_id"),
        _text("v.trip.route_id").alias("route_id"),
        wire_default("v.position.latitude").alias("latitude"),
        wire_default("v.position.longitude").alias("longitude"),
        F.col("v.position.bearing").alias("bearing"),
        F.col("v.position.speed").alias("speed"),
        wire_default("v.current_stop_sequence").alias("current_stop_sequence"),
        F.col("v.occupancy_status").alias("occupancy_status"),
        wire_default("v.timestamp").alias("vehicle_timestamp"),
    )
    return _typed(rows, S.VEHICLE_POSITIONS_ROW)


PACKED_SCHEMA = "partition_key string, value string, rows int"


def pack_rows(df: DataFrame, size: int = S.ROWS_PER_RECORD) -> DataFrame:
    """Group rows into records of at most ``size`` newline-delimited JSON rows.

    Rows are packed in the order their partition holds them, and a record takes the key
    of its first row, so nothing is shuffled and no route can make a task too large. The
    JSON is built by Spark; Python only joins lines, one Arrow batch at a time.
    """
    key = partition_key() if "vehicle_id" in df.columns else partition_key("route_id", "route_id")
    lines = df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("line"))

    # Self-contained, so that workers need no copy of this package.
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records(keys: list[str], lines: list[str]) -> pd.DataFrame:
            starts = range(0, len(lines), size)
            packed = [lines[i:i + size] for i in starts]
            return pd.DataFrame(
                {
                    "partition_key": [keys[i] for i in starts],
                    "value": ["\n".join(p) + "\n" for p in packed],
                    "rows": [len(p) for p in packed],
                }
            )

        keys: list[str] = []
        held: list[str] = []
        for batch in batches:
            keys += batch["key"].tolist()
            held += batch["line"].tolist()
            full = len(held) - len(held) % size
            if full:
                yield records(keys[:full], held[:full])
                keys, held = keys[full:], held[full:]
        if held:
            yield records(keys, held)

    return lines.mapInPandas(pack, PACKED_SCHEMA)


def unpack_rows(df: DataFrame, col: str = "value") -> DataFrame:
    """One line per row again; works on batch and streaming frames."""
    line = F.trim(F.col("_line"))
    others = [c for c in df.columns if c != col]
    return (
        df.select(*others, F.explode(F.split(F.col(col).cast("string"), "\r?\n")).alias("_line"))
        .where(line != "")
        .select(*others, line.alias("line"))
    )


def parse_lines(df: DataFrame, schema: T.StructType = S.BRONZE_ROW) -> DataFrame:
    """The columns of ``df``, the parsed ``_row``, and ``_bad`` for lines that are no such JSON object."""
    corrupt = "_corrupt"
    with_corrupt = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # Behind a generator the parsed row is a value, so the filters below test it instead of
    # parsing the line once more each.
    row = F.explode(F.array(F.from_json("line", with_corrupt, options))).alias("_row")
    is_bad = F.col("_row").isNull() | F.col(f"_row.{corrupt}").isNotNull()
    return df.select("*", row).withColumn("_bad", is_bad)


def parse_rows(df: DataFrame, schema: T.StructType = S.BRONZE_ROW) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the lines that are no such JSON object."""
    parsed = parse_lines(df, schema)
    others = [c for c in df.columns if c != "line"]
    good = parsed.where(~F.col("_bad")).select(*others, *[F.col(f"_row.{n}") for n in schema.names])
    bad = parsed.where("_bad").select(*others, "line")
    return good, bad

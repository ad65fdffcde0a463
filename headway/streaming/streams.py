"""Structured Streaming: landing, live state, streaming silver."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headway import schemas as S
from headway.functions.columns import blank_to_null, number, plausible
from headway.operators.feed import PACKED_SCHEMA, parse_lines, parse_rows, unpack_rows
from headway.operators.live import live_arrivals, prior_state, route_state_batch, stop_key, stop_state
from headway.operators.silver import build_silver, upsert_silver
from headway.sinks.tables import reject_undated, upsert, write_partitions

log = logging.getLogger(__name__)

#: Hash buckets of a state table unless told otherwise; a layout choice, kept with the table.
STATE_BUCKETS = 64
STOP_VERSION = ("updated_at", "current_delay", "trip_id", "stop_sequence")


def stream_rows(spark: SparkSession, path: str | None = None,
                kafka: Mapping[str, str] | None = None, format: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """Packed records from files or Kafka as one JSON line per row (column ``line``).

    Kafka records keep their broker timestamp as ``arrived``.
    """
    if kafka is not None:
        source = spark.readStream.format("kafka").options(**kafka).load()
        records = source.select(F.col("value").cast("string"), F.col("timestamp").alias("arrived"))
        return unpack_rows(records)
    reader = spark.readStream.format(format)
    if format != "text":
        reader = reader.schema(PACKED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return unpack_rows(reader.load(path).select("value"))


def _start(writer, trigger: Mapping[str, object]) -> StreamingQuery:
    return writer.trigger(**trigger).start()


def land_bronze(stream: DataFrame, root: str, checkpoint: str,
                trigger: Mapping[str, object] | None = None, arrived: Column | None = None
                ) -> tuple[StreamingQuery, StreamingQuery]:
    """Land lines as Parquet by record type and arrival hour; bad lines go to ``errors``.

    Partitions follow arrival, not event time: ``arrived`` if given, else the stream's
    own ``arrived`` column, else the clock.
    """
    trigger = trigger or {"processingTime": "300 seconds"}
    good, bad = parse_rows(stream, S.BRONZE_ROW)
    if arrived is None:
        arrived = F.col("arrived") if "arrived" in stream.columns else F.current_timestamp()
    typed = F.col("record_type").isin("trip_updates", "vehicle_positions")
    stamped = good.where(typed).withColumns(
        {"dt": F.date_format(arrived, "yyyy-MM-dd"), "hour": F.date_format(arrived, "HH")}
    )
    unroutable = good.where(~F.coalesce(typed, F.lit(False))).select(
        F.to_json(F.struct(*S.BRONZE_ROW.names)).alias("line")
    )
    rejected = bad.select("line").union(unroutable).withColumn(
        "dt", F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    )
    rows = stamped.select(*S.BRONZE_ROW.names, "dt", "hour")
    landing = rows.writeStream.format("parquet").partitionBy("record_type", "dt", "hour")
    errors = rejected.writeStream.format("json").partitionBy("dt")
    return (
        _start(
            landing.option("path", f"{root}/raw").option("checkpointLocation", f"{checkpoint}/raw"),
            trigger,
        ),
        _start(
            errors.option("path", f"{root}/errors")
            .option("checkpointLocation", f"{checkpoint}/errors"),
            trigger,
        ),
    )


def start_landing(stream: DataFrame, root: str, checkpoint: str,
                  trigger: Mapping[str, object] | None = None, arrived: Column | None = None
                  ) -> StreamingQuery:
    """``land_bronze`` as one query: each line is parsed once for both tables.

    Rows go to ``raw`` by record type, arrival hour and batch, all other lines as they came
    to ``errors`` by day and batch. A batch delivered twice replaces its own folders: what
    stands for the arrival is in the stream, or is the trigger's time, which the
    checkpoint keeps.
    """
    parsed = parse_lines(stream)
    if arrived is None:
        arrived = F.col("arrived") if "arrived" in stream.columns else F.current_timestamp()
    kept = [c for c in stream.columns if c not in S.BRONZE_ROW.names]
    rows = parsed.select(*kept, "_bad", *[F.col(f"_row.{n}") for n in S.BRONZE_ROW.names])
    typed = F.col("record_type").isin("trip_updates", "vehicle_positions")
    rows = rows.select(
        *S.BRONZE_ROW.names, "line", (~F.col("_bad") & F.coalesce(typed, F.lit(False))).alias("routed"),
        F.date_format(arrived, "yyyy-MM-dd").alias("dt"), F.date_format(arrived, "HH").alias("hour"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd").alias("seen"),
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("batch", F.lit(batch_id)).persist()
        try:
            landed = batch.where("routed").select(*S.BRONZE_ROW.names, "dt", "hour", "batch")
            write_partitions(landed, f"{root}/raw", ["record_type", "dt", "hour", "batch"])
            rejected = batch.where("NOT routed").select("line", F.col("seen").alias("dt"), "batch")
            write_partitions(rejected, f"{root}/errors", ["dt", "batch"], format="json")
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, trigger or {"processingTime": "300 seconds"})


def write_state(state: DataFrame, path: str, version: str | tuple[str, ...],
                buckets: int = STATE_BUCKETS) -> None:
    """One write per key and batch into the state table, newest version kept.

    The table is split into hash buckets so that a batch rewrites only what it touches; a
    table keeps the number of ``buckets`` it was begun with.
    """
    bucketed = state.withColumn("bucket", F.pmod(F.xxhash64("pk"), F.lit(buckets)).cast("int"))
    upsert(state.sparkSession, path, bucketed, ["bucket", "pk", "sk"], version, "bucket")


def start_live_state(stream: DataFrame, path: str, checkpoint: str, ttl: int = S.STATE_TTL_SECONDS,
                     trigger: Mapping[str, object] | None = None, clock: Column | None = None,
                     buckets: int = STATE_BUCKETS) -> StreamingQuery:
    """Keep ``path/stops`` and ``path/routes`` current from a stream of lines.

    State never goes backwards: an older batch, or a batch delivered twice, changes
    nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows, _ = parse_rows(batch, S.LIVE_ROW)
        rows = rows.persist()
        try:
            write_state(stop_state(rows, clock, ttl), f"{path}/stops", STOP_VERSION, buckets)
            routes = route_state_batch(rows, clock, ttl).withColumn("batch", F.lit(batch_id))
            write_state(routes, f"{path}/routes", ("updated_at", "batch"), buckets)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, trigger or {"processingTime": "30 seconds"})


def write_priors(priors: DataFrame, path: str, as_of: int, geometry: DataFrame | None = None
                 ) -> None:
    """Export priors as ``path/priors``, keyed for lookup; a later export replaces a cell."""
    state = prior_state(priors, geometry).withColumn("updated_at", F.lit(as_of).cast("bigint"))
    write_state(state, f"{path}/priors", "updated_at")


def read_state(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The ``stops``, ``routes`` or ``priors`` of a state folder."""
    return spark.read.parquet(f"{path}/{kind}").drop("bucket", "batch")


def start_silver(stream: DataFrame, path: str, checkpoint: str, dims: Mapping[str, DataFrame],
                 trigger: Mapping[str, object] | None = None, zone: str = "UTC",
                 rejects: str | None = None) -> StreamingQuery:
    """Streaming silver: each micro-batch is collapsed and upserted like a nightly run.

    After any number of triggers the table is what one build over all their rows gives.
    Rows whose start date is no date go to ``rejects`` (else ``path`` and ``_rejects``) under
    ``batch=``, the checkpoint's batch number, and their number is logged.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows, _ = parse_rows(batch, S.TRIP_UPDATES_ROW)
        updates = rows.where(F.col("record_type") == "trip_updates")
        silver = build_silver(updates, **dims, zone=zone, leads=True).persist()
        try:
            rejected = reject_undated(silver, rejects or f"{path}_rejects", batch=batch_id)
            if rejected:
                log.warning("batch %d: %d rows without a service date rejected", batch_id, rejected)
            upsert_silver(batch.sparkSession, path, silver.where(F.col("service_date").isNotNull()))
        finally:
            silver.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, trigger or {"processingTime": "300 seconds"})


# --- native stateful forms: streaming frames in, streaming frames out ---------------


def stop_state_stream(rows: DataFrame) -> DataFrame:
    """Newest state per (route, stop) as a streaming aggregate (update or complete mode)."""
    newest = F.max(
        F.struct(
            F.col("ingest_ts").alias("updated_at"),
            F.round(number(F.col("arrival_delay")), 3).alias("current_delay"),
            "trip_id",
            "stop_sequence",
        )
    )
    live = rows.where(
        blank_to_null(F.col("route_id")).isNotNull()
        & blank_to_null(F.col("stop_id")).isNotNull()
        & plausible(F.col("arrival_delay"))
    )
    return live.groupBy("route_id", "stop_id").agg(newest.alias("_s")).select(
        "route_id", "stop_id", "_s.*"
    )


def route_state_stream(rows: DataFrame, width: str = "15 minutes", slide: str = "1 minute",
                       delay: str = "5 minutes", exact: bool = False) -> DataFrame:
    """Sliding mean delay and vehicles per route; late rows count up to the watermark.

    Vehicles are counted by a sketch of fixed size, or exactly from the set of a route's
    vehicles in a window, which a fleet bounds.
    """
    vehicles = F.size(F.collect_set("vehicle_id")).cast("long") if exact else F.approx_count_distinct("vehicle_id")
    live = rows.where(blank_to_null(F.col("route_id")).isNotNull()).withColumn(
        "at", F.timestamp_seconds("ingest_ts")
    )
    value = F.when(plausible(F.col("arrival_delay")), number(F.col("arrival_delay")))
    return (
        live.withWatermark("at", delay)
        .groupBy(F.window("at", width, slide), "route_id")
        .agg(
            F.avg(value).alias("mean_route_delay_15m"),
            vehicles.alias("vehicles_active_on_route"),
        )
    )


_VERSION = "updated_at long, current_delay double, trip_id string, stop_sequence int"


def stop_changes(rows: DataFrame, ttl: int = S.STATE_TTL_SECONDS, delay: str = "5 minutes") -> DataFrame:
    """Changes of live state per (route, stop), from keyed state that expires (append mode).

    A key's row comes out when a newer version arrives, and once more with ``expired`` when
    the watermark passes its last update by ``ttl`` seconds; then the key leaves the state
    store. What a trigger writes grows with the keys it changes, not with the keys there are.
    Rows behind the watermark and versions no newer than the known one change nothing.
    """
    arrivals = live_arrivals(rows).select(
        "route_id", "stop_id", F.timestamp_seconds("ingest_ts").alias("at"),
        F.col("ingest_ts").alias("updated_at"), F.round(number(F.col("arrival_delay")), 3).alias("current_delay"),
        F.coalesce("trip_id", F.lit("")).alias("trip_id"),
        F.coalesce("stop_sequence", F.lit(0)).cast("int").alias("stop_sequence"),
    ).where(F.col("updated_at").isNotNull())

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        columns = ["updated_at", "current_delay", "trip_id", "stop_sequence"]
        known = tuple(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(*key, *known, True)], columns=["route_id", "stop_id", *columns, "expired"])
            return
        newest = known
        for batch in batches:
            for version in batch[columns].itertuples(index=False, name=None):
                newest = version if newest is None or version > newest else newest
        newest = (int(newest[0]), float(newest[1]), newest[2], int(newest[3]))
        state.update(newest)
        state.setTimeoutTimestamp((newest[0] + ttl) * 1000)
        if newest != known:
            yield pd.DataFrame([(*key, *newest, False)], columns=["route_id", "stop_id", *columns, "expired"])

    return arrivals.withWatermark("at", delay).groupBy("route_id", "stop_id").applyInPandasWithState(
        advance, f"route_id string, stop_id string, {_VERSION}, expired boolean", _VERSION, "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def start_stop_changes(stream: DataFrame, path: str, checkpoint: str, ttl: int = S.STATE_TTL_SECONDS,
                       trigger: Mapping[str, object] | None = None, delay: str = "5 minutes") -> StreamingQuery:
    """Append the changes of live stop state to the log at ``path``."""
    rows, _ = parse_rows(stream, S.LIVE_ROW)
    writer = (
        stop_changes(rows, ttl, delay).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _start(writer, trigger or {"processingTime": "30 seconds"})


def state_of_changes(changes: DataFrame) -> DataFrame:
    """The live state that a log of changes leaves: the last version of every key that has not expired."""
    last = F.max(F.struct("updated_at", "expired", "current_delay", "trip_id", "stop_sequence")).alias("_s")
    return changes.groupBy("route_id", "stop_id").agg(last).where("NOT _s.expired").select(
        stop_key().alias("pk"), F.lit("CURRENT").alias("sk"), "route_id", "stop_id", "_s.current_delay",
        "_s.trip_id", "_s.stop_sequence", "_s.updated_at",
    )


def start_route_windows(stream: DataFrame, path: str, checkpoint: str, width: str = "15 minutes",
                        slide: str = "5 minutes", delay: str = "5 minutes",
                        trigger: Mapping[str, object] | None = None, exact: bool = False) -> StreamingQuery:
    """Append each route's window to ``path`` once the watermark has passed its end."""
    rows, _ = parse_rows(stream, S.LIVE_ROW)
    windows = route_state_stream(rows, width, slide, delay, exact).select(
        F.unix_timestamp("window.start").alias("window_start"), F.unix_timestamp("window.end").alias("window_end"),
        "route_id", "mean_route_delay_15m", "vehicles_active_on_route",
    )
    writer = (
        windows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return _start(writer, trigger or {"processingTime": "60 seconds"})

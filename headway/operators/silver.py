"""Bronze predictions to one row per arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import local_time, null_outside, weekend
from headway.operators.ranges import with_group_values
from headway.session import stage
from headway.sinks.tables import merge_newer, upsert_with

# Total order of "latest": ingest time, then arrival time and delay, then the payload,
# so that equal timestamps always give the same row. NULL sorts below any value.
LATEST_ORDER = (
    "ingest_ts", "arrival_time", "arrival_delay", "vehicle_id", "route_id",
    "direction_id", "stop_sequence",
)


# The later of two stored rows of a key, as far as the stored columns tell.
SILVER_VERSION = ("last_seen_ts", "observed_arrival_epoch", "observed_delay_sec", "vehicle_id")


def valid_updates(df: DataFrame, canceled: int = S.CANCELED) -> DataFrame:
    """Rows with a full key whose trip is not cancelled; no status means scheduled."""
    complete = [F.col(k).isNotNull() for k in S.KEY]
    running = F.coalesce(F.col("schedule_relationship"), F.lit(0)) != canceled
    return df.where(complete[0] & complete[1] & complete[2] & running)


def latest_per_key(df: DataFrame, keys: Sequence[str] = S.KEY,
                   order: Sequence[str] = LATEST_ORDER) -> DataFrame:
    """The greatest row of each key in ``order``; the remaining columns break ties.

    A ``max`` over one struct combines before the shuffle, so a key that holds a third
    of the table still sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    latest = F.max(F.struct(*order, *rest)).alias("_latest")
    grouped = df.groupBy(*keys).agg(latest)
    return grouped.select(*keys, "_latest.*").select(*df.columns)


def _snapshot(minutes: int) -> Column:
    """Nearest prediction made at least ``minutes`` ahead, as one aggregate."""
    lead = F.col("arrival_time") - F.col("ingest_ts")
    nearest_first = F.struct((-lead).alias("_near"), F.col("ingest_ts"), F.col("arrival_delay"))
    return F.max(F.when(lead >= minutes * 60, nearest_first))


def snapshot_at(df: DataFrame, minutes: int, keys: Sequence[str] = S.KEY) -> DataFrame:
    """The prediction closest to, but not later than, ``minutes`` before arrival."""
    lead = F.col("arrival_time") - F.col("ingest_ts")
    return (
        df.where(lead >= minutes * 60)
        .groupBy(*keys)
        .agg(_snapshot(minutes).alias("_snap"))
        .select(
            *keys,
            F.col("_snap.arrival_delay").alias(f"delay_t_minus_{minutes}"),
            F.col("_snap.ingest_ts").alias(f"snap_ts_t_minus_{minutes}"),
        )
    )


def lead_column(horizon: int) -> str:
    """How long before its arrival a snapshot was taken; stored beside the declared columns."""
    return f"snap_lead_t_minus_{horizon}"


def collapse(df: DataFrame, horizons: Sequence[int] = S.HORIZONS,
             keys: Sequence[str] = S.KEY, leads: bool = False) -> DataFrame:
    """Last observation and every horizon's snapshot in one aggregation.

    One scan and one shuffle of pre-combined rows, where ranking windows joined to each
    other would sort and shuffle the raw predictions once per horizon.
    """
    latest = F.max(F.struct(*LATEST_ORDER)).alias("_latest")
    snaps = [_snapshot(h).alias(f"_snap_{h}") for h in horizons]
    out = [
        F.col("_latest.route_id"),
        F.col("_latest.direction_id"),
        F.col("_latest.vehicle_id"),
        F.col("_latest.stop_sequence"),
        F.col("_latest.arrival_time").alias("observed_arrival_epoch"),
        F.col("_latest.arrival_delay").alias("observed_delay_sec"),
        F.col("_latest.ingest_ts").alias("last_seen_ts"),
    ]
    out += [F.col(f"_snap_{h}.arrival_delay").alias(f"delay_t_minus_{h}") for h in horizons]
    out += [F.col(f"_snap_{h}.ingest_ts").alias(f"snap_ts_t_minus_{h}") for h in horizons]
    if leads:
        out += [(-F.col(f"_snap_{h}._near")).alias(lead_column(h)) for h in horizons]
    return df.groupBy(*keys).agg(latest, *snaps).select(*keys, *out)


def recover_route(events: DataFrame, trips: DataFrame) -> DataFrame:
    """Fill a missing route from the schedule; a trip listed twice takes its lowest route."""
    known = trips.groupBy("trip_id").agg(F.min("route_id").alias("sched_route_id"))
    return (
        events.join(known, "trip_id", "left")
        .withColumn("route_id", F.coalesce("route_id", "sched_route_id"))
        .drop("sched_route_id")
    )


def join_schedule(events: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Scheduled arrival and distance for each event, without fan-out on loop trips.

    A trip that visits a stop twice has two schedule rows: the one with the event's own
    sequence wins, else the first visit. Both sides of that choice are reduced to one row
    per join key beforehand, so the events are never multiplied.
    """
    visits = stop_times.select(
        "trip_id",
        "stop_id",
        F.col("stop_sequence").try_cast("int").alias("_seq"),
        F.struct(
            F.col("arrival_time").alias("scheduled_arrival"),
            F.col("shape_dist_traveled").try_cast("double").alias("shape_dist_traveled"),
        ).alias("_visit"),
    )
    exact = (
        visits.where(F.col("_seq").isNotNull())
        .groupBy("trip_id", "stop_id", F.col("_seq").alias("stop_sequence"))
        .agg(F.min("_visit").alias("_exact"))
    )
    first_order = F.struct(F.col("_seq").isNull().alias("_none"), "_seq", "_visit")
    first = visits.groupBy("trip_id", "stop_id").agg(F.min(first_order)["_visit"].alias("_first"))
    return (
        events.join(first, ["trip_id", "stop_id"], "left")
        .join(exact, ["trip_id", "stop_id", "stop_sequence"], "left")
        .withColumn("_visit", F.coalesce("_exact", "_first"))
        .select(*events.columns, "_visit.scheduled_arrival", "_visit.shape_dist_traveled")
    )


def join_dimensions(events: DataFrame, stop_times: DataFrame, stops: DataFrame,
                    trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Schedule, stop position, recovered route, then route facts.

    No broadcast hints: Spark broadcasts a dimension only where its measured size allows
    it, and a hot trip on the event side is split by the adaptive skew join otherwise.
    """
    place = stops.groupBy("stop_id").agg(
        F.min(
            F.struct(
                F.col("stop_lat").try_cast("double").alias("stop_lat"),
                F.col("stop_lon").try_cast("double").alias("stop_lon"),
            )
        ).alias("_place")
    )
    facts = routes.groupBy("route_id").agg(
        F.min(
            F.struct("route_short_name", F.col("route_type").try_cast("int").alias("route_type"))
        ).alias("_route")
    )
    scheduled = join_schedule(events, stop_times)
    enriched = recover_route(scheduled.join(place, "stop_id", "left"), trips)
    kept = [c for c in enriched.columns if c != "_place"]
    return enriched.join(facts, "route_id", "left").select(
        *kept, "_place.stop_lat", "_place.stop_lon",
        "_route.route_short_name", "_route.route_type",
    )


def place_in_trip(events: DataFrame) -> DataFrame:
    """Stops remaining and terminus flag, against the last stop observed that day."""
    last = F.max("stop_sequence").alias("_last_stop")
    placed = with_group_values(events, ["start_date", "trip_id"], last)
    return placed.withColumns(
        {
            "stops_remaining": F.col("_last_stop") - F.col("stop_sequence"),
            "is_terminus": (F.col("stop_sequence") == F.col("_last_stop")).cast("int"),
        }
    ).drop("_last_stop")


def derive(events: DataFrame, zone: str = "UTC") -> DataFrame:
    """Service date, clock features, place in the trip, and bounded labels."""
    clock = local_time(F.col("observed_arrival_epoch"), zone)
    return place_in_trip(events).withColumns(
        {
            "service_date": F.try_to_timestamp("start_date", F.lit("yyyyMMdd")).cast("date"),
            "observed_arrival_ts": F.timestamp_seconds("observed_arrival_epoch"),
            "hour_of_day": F.hour(clock),
            "day_of_week": F.dayofweek(clock),
            "observed_delay_sec": null_outside(F.col("observed_delay_sec")),
        }
    ).withColumn("is_weekend", weekend(F.col("day_of_week")))


def build_silver(updates: DataFrame, stop_times: DataFrame, stops: DataFrame, trips: DataFrame,
                 routes: DataFrame, zone: str = "UTC", leads: bool = False) -> DataFrame:
    """One row per (service_date, trip_id, stop_id), columns as declared.

    ``leads`` adds each snapshot's lead, which ``merge_silver`` needs.

    The collapsed rows are written down once: the place in the trip reads them twice, and
    without that the whole feed would be scanned and collapsed a second time.
    """
    events = stage(collapse(valid_updates(updates), leads=leads), "collapsed")
    silver = join_dimensions(derive(events, zone), stop_times, stops, trips, routes)
    extra = [lead_column(h) for h in S.HORIZONS] if leads else []
    return silver.select(*S.STOP_EVENTS_SCHEMA.names, *extra)


def merge_silver(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Two silver tables as one build over the predictions of both would give.

    The later observation gives the row, each horizon keeps the nearest snapshot of either,
    and places in trips are counted again over the merged rows, so both sides must hold
    whole service dates. Rows stored without leads take the lead to the observed arrival.
    """
    snapshots: dict[str, Column] = {}
    for h in S.HORIZONS:
        nearest = F.greatest(_stored_snapshot("_t", h), _stored_snapshot("_s", h))
        snapshots[f"delay_t_minus_{h}"] = nearest["delay"]
        snapshots[f"snap_ts_t_minus_{h}"] = nearest["ts"]
        snapshots[lead_column(h)] = -nearest["near"]
    rows = merge_newer(target, staged, S.SILVER_KEY, SILVER_VERSION, computed=snapshots)
    return place_in_trip(rows).select(*target.columns)


def _stored_snapshot(side: str, h: int) -> Column:
    """One side's snapshot, nearest to its arrival first; NULL where that side has none."""
    row = F.col(side)
    lead = F.coalesce(
        row[lead_column(h)], row["observed_arrival_epoch"] - row[f"snap_ts_t_minus_{h}"]
    )
    return F.when(lead.isNotNull(), F.struct(
        (-lead).alias("near"), row[f"snap_ts_t_minus_{h}"].alias("ts"), row[f"delay_t_minus_{h}"].alias("delay")
    ))


def upsert_silver(spark: SparkSession, path: str, staged: DataFrame) -> list:
    """Merge a build with leads into the stored table; returns the service dates touched."""
    return upsert_with(spark, path, staged, "service_date", merge_silver)

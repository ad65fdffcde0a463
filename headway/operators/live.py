"""Live state per stop and route, and batch scoring from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import (
    blank_to_null,
    is_peak_hour,
    local_time,
    number,
    plausible,
    weekend,
)
from headway.operators.gold import route_state
from headway.operators.ranges import ordered_context


def stop_key(route: str = "route_id", stop: str = "stop_id") -> Column:
    return F.concat(F.lit("ROUTE#"), F.col(route), F.lit("#STOP#"), F.col(stop))


def route_key(route: str = "route_id") -> Column:
    return F.concat(F.lit("ROUTE#"), F.col(route))


def stats_key(is_weekend: Column, hour: Column) -> Column:
    return F.concat(
        F.lit("STATS#"), is_weekend.cast("string"), F.lit("#"),
        F.lpad(hour.cast("string"), 2, "0"),
    )


def live_arrivals(rows: DataFrame) -> DataFrame:
    """Rows with a route, a stop and a plausible delay."""
    return rows.where(
        blank_to_null(F.col("route_id")).isNotNull()
        & blank_to_null(F.col("stop_id")).isNotNull()
        & (F.coalesce(F.col("record_type"), F.lit("")) != "vehicle_positions")
        & plausible(F.col("arrival_delay"))
    )


def stop_state(rows: DataFrame, now: Column | None = None, ttl: int = S.STATE_TTL_SECONDS
               ) -> DataFrame:
    """Newest state of every (route, stop); ties go to the greater delay, trip, sequence."""
    now = now if now is not None else F.unix_timestamp()
    newest = F.max(
        F.struct(
            F.coalesce(F.col("ingest_ts"), now).alias("updated_at"),
            F.round(number(F.col("arrival_delay")), 3).alias("current_delay"),
            F.coalesce("trip_id", F.lit("")).alias("trip_id"),
            F.coalesce("stop_sequence", F.lit(0)).alias("stop_sequence"),
        )
    )
    return (
        live_arrivals(rows).groupBy("route_id", "stop_id").agg(newest.alias("_s"))
        .select(
            stop_key().alias("pk"),
            F.lit("CURRENT").alias("sk"),
            "route_id",
            "stop_id",
            "_s.current_delay",
            "_s.trip_id",
            "_s.stop_sequence",
            "_s.updated_at",
            (now + ttl).alias("ttl"),
        )
    )


def _route_values() -> tuple[Column, Column]:
    """What a row adds to its route: a plausible delay at a stop, or a vehicle's position."""
    counts = (F.col("record_type") != "vehicle_positions") | F.col("record_type").isNull()
    stop = blank_to_null(F.col("stop_id")).isNotNull()
    delay = F.when(
        counts & stop & plausible(F.col("arrival_delay")), number(F.col("arrival_delay"))
    )
    vehicle = F.when(
        F.col("record_type") == "vehicle_positions", blank_to_null(F.col("vehicle_id"))
    )
    return delay, vehicle


def route_state_batch(rows: DataFrame, now: Column | None = None, ttl: int = S.STATE_TTL_SECONDS
                      ) -> DataFrame:
    """Mean delay and distinct vehicles of a batch, for every route with a plausible delay."""
    now = now if now is not None else F.unix_timestamp()
    delay, vehicle = _route_values()
    return (
        rows.where(blank_to_null(F.col("route_id")).isNotNull())
        .groupBy("route_id")
        .agg(
            F.count(delay).alias("_n"),
            F.round(F.avg(delay), 3).alias("mean_route_delay_15m"),
            F.count_distinct(vehicle).alias("vehicles_active_on_route"),
        )
        .where("_n > 0")
        .select(
            route_key().alias("pk"),
            F.lit("ROUTESTATE").alias("sk"),
            "route_id",
            "mean_route_delay_15m",
            "vehicles_active_on_route",
            now.alias("updated_at"),
            (now + ttl).alias("ttl"),
        )
    )


def alive(state: DataFrame, as_of: Column | int) -> DataFrame:
    """State that has not expired."""
    return state.where(F.col("ttl") > (F.lit(as_of) if isinstance(as_of, int) else as_of))


def prior_state(priors: DataFrame, geometry: DataFrame | None = None) -> DataFrame:
    """Priors keyed for lookup by stop and STATS#weekend#hour.

    ``geometry`` may add (route_id, stop_id, stops_remaining, shape_dist_traveled,
    is_terminus, route_type), one row per route and stop.
    """
    keyed = priors.where(F.col("route_id").isNotNull()).select(
        stop_key().alias("pk"), stats_key(F.col("is_weekend"), F.col("hour_of_day")).alias("sk"),
        *priors.columns,
    )
    return keyed if geometry is None else keyed.join(geometry, ["route_id", "stop_id"], "left")


def stop_geometry(silver: DataFrame) -> DataFrame:
    """What the schedule says about a stop on a route, from its newest arrivals."""
    facts = ("stops_remaining", "shape_dist_traveled", "is_terminus", "route_type")
    newest = F.max(F.struct("service_date", "last_seen_ts", "trip_id", *facts)).alias("_g")
    return (
        silver.where(F.col("route_id").isNotNull()).groupBy("route_id", "stop_id").agg(newest)
        .select("route_id", "stop_id", *[f"_g.{f}" for f in facts])
    )


def with_upstream_state(state: DataFrame) -> DataFrame:
    """Delay at the trip's previous stop and mean over its earlier stops, from live state."""
    placed = ordered_context(
        state, keys=("trip_id",), order=("stop_sequence", "route_id", "stop_id"),
        chunk=F.floor(F.col("stop_sequence") / 64),
        lag={"prev_stop_delay": "current_delay"}, running={"_up": "current_delay"},
    )
    mean = F.col("_up_sum") / F.nullif(F.col("_up_n"), F.lit(0))
    return placed.withColumn("upstream_delay", mean).drop("_up_sum", "_up_n")


def request_features(requests: DataFrame, stops: DataFrame, routes: DataFrame,
                     priors: DataFrame, now: datetime | Column, zone: str = "UTC",
                     by: Sequence[str] = ()) -> DataFrame:
    """The contract's features for each (route_id, stop_id) request, NULL where unknown.

    Three left joins stand for three lookups per request. The clock runs through the same
    function as the offline features, so both sides agree on the hour. ``by`` names further
    columns that requests, stops and routes are matched by, such as the time of the request.
    Priors with a column ``as_of`` are those of the request's own date.
    """
    epoch = F.lit(int(now.timestamp())) if isinstance(now, datetime) else now
    clock = local_time(F.col("_now"), zone)
    timed = requests.withColumn("_now", epoch).withColumns(
        {
            "hour_of_day": F.hour(clock),
            "day_of_week": F.dayofweek(clock),
            "minutes_since_service_start": F.hour(clock) * 60 + F.minute(clock),
        }
    ).withColumns(
        {
            "is_weekend": weekend(F.col("day_of_week")),
            "is_peak": is_peak_hour(F.col("hour_of_day")),
            "is_holiday": F.lit(0),
            "service_date": F.to_date(clock),
        }
    )
    have = stops.columns
    current = stops.select(
        "route_id", "stop_id", *by, "trip_id", "stop_sequence",
        F.col("current_delay").alias("delay_t_minus_15"),
        *[F.col(c) for c in ("prev_stop_delay",) if c in have],
        *[F.col("upstream_delay").alias("upstream_delay_same_trip")
          for c in ("upstream_delay",) if c in have],
    )
    route = routes.select(
        "route_id", *by,
        *[c for c in ("mean_route_delay_15m", "vehicles_active_on_route", "preceding_trip_delay",
                      *S.WEATHER_FALLBACK, "active_alert_on_route") if c in routes.columns],
    )
    stats = priors.drop("pk", "sk", "updated_at").withColumnRenamed("as_of", "service_date")
    dated = [c for c in ("service_date",) if c in stats.columns]
    joined = (
        timed.join(current, ["route_id", "stop_id", *by], "left")
        .join(route, ["route_id", *by], "left")
        .join(stats, ["route_id", "stop_id", "is_weekend", "hour_of_day", *dated], "left")
        .drop("_now")
    )
    absent = [n for n in S.FEATURE_NAMES if n not in joined.columns]
    return joined.withColumns({n: F.lit(None).cast("double") for n in absent})


# --- live state as it was ------------------------------------------------------------


def stop_state_at(rows: DataFrame, asked: DataFrame, ttl: int = S.STATE_TTL_SECONDS) -> DataFrame:
    """The state of each asked (route_id, stop_id) as it was at ``asked_at``, if alive then.

    Equals ``stop_state`` over the rows up to that second. Time is cut into slots of ``ttl``:
    a row is alive in its own slot and the next at most, so it goes to both, each slot is
    swept once in its own task, and neither a busy stop nor a long history makes one group.
    Rows of one second are reduced to one before. Rows without a time take no part.
    """
    place = ["route_id", "stop_id"]
    value = F.struct(
        F.round(number(F.col("arrival_delay")), 3).alias("current_delay"),
        F.coalesce("trip_id", F.lit("")).alias("trip_id"),
        F.coalesce("stop_sequence", F.lit(0)).alias("stop_sequence"),
    )
    updates = (
        live_arrivals(rows).where(F.col("ingest_ts").isNotNull())
        .groupBy(*place, F.col("ingest_ts").cast("long").alias("_at")).agg(F.max(value).alias("_s"))
        .withColumn("_updated", F.col("_at"))
    )
    slot = F.floor(F.col("_at") / ttl)
    serving = updates.withColumn("_slot", F.explode(F.array(slot, slot + 1)))
    questions = (
        asked.select(*place, F.col("asked_at").cast("long").alias("_at"))
        .where(F.col("_at").isNotNull()).distinct().withColumn("_slot", slot)
    )
    events = serving.withColumn("_asks", F.lit(False)).unionByName(
        questions.withColumn("_asks", F.lit(True)), allowMissingColumns=True
    )
    so_far = Window.partitionBy(*place, "_slot").orderBy("_at", "_asks").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    answers = events.withColumns(
        {c: F.last(c, ignorenulls=True).over(so_far) for c in ("_s", "_updated")}
    )
    return answers.where(F.col("_asks") & (F.col("_updated") > F.col("_at") - ttl)).select(
        *place, F.col("_at").alias("asked_at"), "_s.*", F.col("_updated").alias("updated_at")
    )


def route_state_at(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Mean delay and vehicles of each asked route over the 15 minutes before ``asked_at``.

    The same sweep as the strict offline form, over feed rows; questions add nothing to it.
    """
    delay, vehicle = _route_values()
    names = ("route_id", "snap_ts_t_minus_15", "delay_t_minus_15", "vehicle_id", "asked_at")
    fed = rows.where(blank_to_null(F.col("route_id")).isNotNull() & F.col("ingest_ts").isNotNull()).select(
        "route_id", F.col("ingest_ts").cast("long"), delay, vehicle, F.lit(None).cast("long")
    ).toDF(*names)
    at = F.col("asked_at").cast("long")
    questions = asked.where(at.isNotNull()).select(
        "route_id", at, F.lit(None).cast("double"), F.lit(None).cast("string"), at
    ).toDF(*names).distinct()
    both = fed.unionByName(questions).withColumn("service_date", F.lit(None).cast("date"))
    return route_state(both, strict=True).where(F.col("asked_at").isNotNull()).select(
        "route_id", "asked_at", "mean_route_delay_15m", "vehicles_active_on_route"
    )


def replayed_features(asked: DataFrame, rows: DataFrame, priors: DataFrame, zone: str = "UTC",
                      ttl: int = S.STATE_TTL_SECONDS) -> DataFrame:
    """What online scoring would have read for every asked row at its own ``asked_at``.

    ``asked``: keys, ``route_id``, ``stop_id`` and ``asked_at`` (seconds); rows that ask the
    same are answered once. Rows without a route or time are answered with nothing but NULLs.
    """
    question = ["route_id", "stop_id", "asked_at"]
    distinct = asked.withColumn("asked_at", F.col("asked_at").cast("long")).select(*question).distinct()
    features = request_features(
        distinct, stop_state_at(rows, distinct, ttl), route_state_at(rows, distinct), priors,
        F.col("asked_at"), zone, by=("asked_at",),
    )
    keys = [c for c in asked.columns if c not in S.FEATURE_NAMES]
    return asked.select(*keys).join(features.select(*question, *S.FEATURE_NAMES), question, "left")

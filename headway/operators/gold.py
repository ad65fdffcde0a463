"""Silver to the point-in-time feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import is_peak_hour, local_time
from headway.operators.ranges import (
    discrete_quantiles,
    ordered_context,
    value_counts,
    with_group_values,
)

CELL = ("route_id", "stop_id", "is_weekend", "hour_of_day")
LAG_SECONDS = 900


def day(df: DataFrame, d: date) -> DataFrame:
    return df.where(F.col("service_date") == F.lit(d))


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col(S.TARGET).isNotNull())


def since(df: DataFrame, as_of: date, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``, and later ones."""
    return df.where(F.col("service_date") >= F.date_sub(F.lit(as_of), days))


def _priors(counts: DataFrame, keys: Sequence[str], min_count: int) -> DataFrame:
    delay = F.col(S.TARGET).cast("double")
    weighted = delay * F.col("n")
    cells = discrete_quantiles(
        counts, keys, S.TARGET, {"hist_median_delay": 0.5, "hist_p90_delay": 0.9},
        extra=[F.sum(weighted).alias("_s1"), F.sum(weighted * delay).alias("_s2")],
    )
    n = F.col("total")
    # Whole-second delays keep both sums exact, so this form loses nothing.
    variance = (F.col("_s2") - F.col("_s1") * F.col("_s1") / n) / F.nullif(n - 1, F.lit(0))
    return cells.where(n >= min_count).select(
        *keys,
        "hist_median_delay",
        "hist_p90_delay",
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("hist_std_delay"),
        n.alias("hist_n"),
    )


def historical_priors(silver: DataFrame, as_of: date, lookback: int = S.LOOKBACK_DAYS,
                      min_count: int = S.MIN_CELL_ROWS) -> DataFrame:
    """Trailing delay profile per route, stop, day type and hour.

    Only dates strictly before ``as_of`` count: that filter is the leakage guard, and it
    prunes silver to the lookback's partitions. Quantiles come from a histogram, which is
    exact at any volume and keeps a hot cell to one row per distinct delay.
    """
    past = labelled(silver).where(
        (F.col("service_date") < F.lit(as_of))
        & (F.col("service_date") >= F.date_sub(F.lit(as_of), lookback))
    )
    return _priors(value_counts(past, CELL, S.TARGET), CELL, min_count)


def daily_histograms(silver: DataFrame) -> DataFrame:
    """Arrivals per day, cell and delay: all that priors need of a day, and far smaller.

    Arrivals without a label are counted under NULL, so every day of silver has rows and
    replacing a day's partition always replaces the old one.
    """
    counted = silver.groupBy("service_date", *CELL, S.TARGET).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*S.HISTOGRAM_SCHEMA.names)


def priors_of_histograms(daily: DataFrame, as_of: date, lookback: int = S.LOOKBACK_DAYS,
                         min_count: int = S.MIN_CELL_ROWS) -> DataFrame:
    """``historical_priors`` from kept daily histograms instead of silver."""
    past = daily.where(
        (F.col("service_date") < F.lit(as_of))
        & (F.col("service_date") >= F.date_sub(F.lit(as_of), lookback))
    )
    return _priors(value_counts(past, CELL, S.TARGET, "n"), CELL, min_count)


def historical_priors_by_day(silver: DataFrame, days: DataFrame,
                             lookback: int = S.LOOKBACK_DAYS,
                             min_count: int = S.MIN_CELL_ROWS) -> DataFrame:
    """The same profile for many run dates in one pass; ``days`` has a column ``as_of``.

    Each day is reduced to its histogram before being handed to the run dates it counts
    for, so what fans out is distinct delays per cell and day, not arrivals. ``days`` may
    also hold the cell columns; then only those cells are profiled on each date. A histogram
    row meets the at most ``lookback`` dates it counts for, never the whole history.
    """
    daily = value_counts(labelled(silver), ("service_date", *CELL), S.TARGET)
    return priors_of_histograms_by_day(daily, days, lookback, min_count)


def priors_of_histograms_by_day(daily: DataFrame, days: DataFrame,
                                lookback: int = S.LOOKBACK_DAYS,
                                min_count: int = S.MIN_CELL_ROWS) -> DataFrame:
    """``historical_priors_by_day`` from kept daily histograms.

    Where cells are asked for, a histogram row is handed out in the join: time is cut into slots
    of ``lookback`` days, and a date looks into its own slot and the one before. Rows copied to
    each of their run dates beforehand would be shuffled and sorted ``lookback`` times.
    """
    daily = labelled(daily)
    if set(CELL) <= set(days.columns):
        slots = max(lookback, 1)
        slot = F.floor(F.unix_date(F.col("as_of")) / slots)
        asked = days.select("as_of", *CELL).distinct().withColumn("_slot", F.explode(F.array(slot - 1, slot)))
        own = daily.withColumn("_slot", F.floor(F.unix_date("service_date") / slots))
        spread = own.join(asked, ["_slot", *CELL]).where(
            (F.col("service_date") < F.col("as_of"))
            & (F.col("service_date") >= F.date_sub("as_of", lookback))
        ).repartition("as_of", *CELL)
    else:
        later = F.sequence(F.date_add("service_date", 1), F.date_add("service_date", lookback))
        spread = daily.withColumn("as_of", F.explode(later)).join(
            days.select("as_of").distinct(), "as_of", "left_semi"
        )
    counts = spread.groupBy("as_of", *CELL, S.TARGET).agg(F.sum("n").alias("n"))
    return _priors(counts, ("as_of", *CELL), min_count)


def upstream_features(df: DataFrame) -> DataFrame:
    """Delay at the previous stop, mean of all earlier stops, and the preceding trip."""
    along_trip = ordered_context(
        df,
        keys=("service_date", "trip_id"),
        order=("stop_sequence", "stop_id"),  # the silver key bounds a trip's stops
        lag={"prev_stop_delay": "delay_t_minus_15"},
        running={"_upstream": "delay_t_minus_15"},
    )
    mean = F.col("_upstream_sum") / F.nullif(F.col("_upstream_n"), F.lit(0))
    along_trip = along_trip.withColumn("upstream_delay_same_trip", mean)
    return ordered_context(
        along_trip.drop("_upstream_sum", "_upstream_n"),
        keys=("service_date", "route_id", "stop_id"),
        order=("observed_arrival_epoch", "trip_id"),
        chunk=F.floor(F.col("observed_arrival_epoch") / LAG_SECONDS),
        lag={"preceding_trip_delay": "delay_t_minus_15"},
    )


def route_state(df: DataFrame, strict: bool = False, exact: bool = False) -> DataFrame:
    """Mean delay and active vehicles of the route.

    Default: over the whole service hour, later rows included. ``strict``: only what was
    snapshot in the 15 minutes before this row's own snapshot, counted exactly. ``exact``
    counts the hour's vehicles exactly instead of by sketch.
    """
    if strict:
        return _strict_route_state(df)
    vehicles = F.count_distinct if exact else F.approx_count_distinct
    return with_group_values(
        df,
        ("service_date", "route_id", "hour_of_day"),
        F.avg("delay_t_minus_15").alias("mean_route_delay_15m"),
        vehicles(F.col("vehicle_id")).alias("vehicles_active_on_route"),
    )


def _strict_route_state(df: DataFrame) -> DataFrame:
    """A sweep over time: what a snapshot adds begins a second after it and ends 900 s later.

    Running sums over these beginnings and ends give each row its mean, and its vehicles
    where every vehicle's overlapping intervals count as one. Time is cut into 900 s slots; an
    interval reaches into the next slot at most, so each row also serves that one, and the
    slots of a hot route run in different tasks. Work and memory are linear in the rows.
    """
    at = F.col("snap_ts_t_minus_15")
    known = at.isNotNull()
    # Rows without a snapshot see nothing and serve nobody; they are spread by their values.
    apart = -1 - F.pmod(F.xxhash64(*df.columns), F.lit(64))
    slot = F.coalesce(F.floor(at / LAG_SECONDS), apart)
    serves = F.when(known, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    group = ["service_date", "route_id", "_slot"]
    spread = df.withColumn("_ahead", F.explode(serves)).withColumn("_slot", slot + F.col("_ahead")).repartition(*group)
    own = Window.partitionBy(*group, "vehicle_id").orderBy(at)
    before, after = F.lag(at).over(own), F.lead(at).over(own)
    counts = known & F.col("vehicle_id").isNotNull()
    begins = (counts & (before.isNull() | (before + LAG_SECONDS < at))).cast("long")
    ends = (counts & (after.isNull() | (after > at + LAG_SECONDS))).cast("long")
    delay = F.coalesce(F.col("delay_t_minus_15").cast("double"), F.lit(0.0))
    n = F.col("delay_t_minus_15").isNotNull().cast("long")

    def event(pos: Column, vehicles: Column, total: Column, rows: Column, is_row: Column) -> Column:
        return F.struct(pos.cast("long").alias("at"), vehicles.alias("vehicles"), total.alias("total"),
                        rows.alias("n"), is_row.alias("is_row"))

    none = F.lit(0).cast("long")
    row = event(at, none, F.lit(0.0), none, F.col("_ahead") == 0)
    events = F.when(known, F.array(
        row, event(at + 1, begins, delay, n, F.lit(False)),
        event(at + LAG_SECONDS + 1, -ends, -delay, -n, F.lit(False)),
    )).otherwise(F.array(row))
    swept = spread.withColumn("_events", events).withColumn("_e", F.explode("_events"))
    so_far = Window.partitionBy(*group).orderBy("_e.at")
    seen = F.sum("_e.n").over(so_far)
    return (
        swept.withColumns(
            {
                "mean_route_delay_15m": F.when(known & (seen > 0), F.sum("_e.total").over(so_far) / seen),
                "vehicles_active_on_route": F.when(known, F.sum("_e.vehicles").over(so_far)),
            }
        )
        .where("_e.is_row")
        .drop("_ahead", "_slot", "_events", "_e")
    )


def join_weather(df: DataFrame, weather: DataFrame | None = None,
                 defaults: Mapping[str, float] = S.FEATURE_DEFAULTS) -> DataFrame:
    """Weather of the service date and hour.

    No weather table at all gives constants; a missing hour gives NULL. Readings of one
    hour are averaged first, so an hour with several rows cannot multiply the events.
    """
    if weather is None:
        return df.withColumns({n: F.lit(float(defaults[n])) for n in S.WEATHER_FALLBACK})
    hourly = weather.groupBy(
        F.to_date("time").alias("service_date"), F.hour("time").alias("hour_of_day")
    ).agg(
        F.avg(F.col("temperature_2m").cast("double")).alias("temp_c"),
        F.avg(F.col("precipitation").cast("double")).alias("precipitation_mm"),
        F.avg(F.col("wind_speed_10m").cast("double")).alias("wind_kph"),
        F.avg(F.col("visibility").cast("double")).alias("visibility_m"),
    )
    return df.join(hourly, ["service_date", "hour_of_day"], "left").select(
        *df.columns, *S.WEATHER_FALLBACK
    )


def build_features(silver: DataFrame, as_of: date | Sequence[date] | DataFrame | None,
                   weather: DataFrame | None = None, zone: str = "UTC",
                   lookback: int = S.LOOKBACK_DAYS, min_count: int = S.MIN_CELL_ROWS,
                   strict: bool = False, exact: bool = False,
                   histograms: DataFrame | None = None) -> DataFrame:
    """Feature rows of one run date, of several, or (``None``) of every date in silver.

    A table of dates (``service_date``) may be a part of the plan, such as the dates that
    pass the gate. With kept ``histograms`` priors do not read silver at all.
    """
    if isinstance(as_of, date):
        today = day(silver, as_of)
        priors = (
            historical_priors(silver, as_of, lookback, min_count) if histograms is None
            else priors_of_histograms(histograms, as_of, lookback, min_count)
        )
        prior_keys = list(CELL)
    else:
        today, past = silver, silver if histograms is None else histograms
        if isinstance(as_of, DataFrame):
            today = silver.join(as_of.select("service_date"), "service_date", "left_semi")
        elif as_of is not None:
            # Dates known beforehand prune the scans: the days themselves, and their history.
            dates = sorted(as_of)
            today = silver.where(F.col("service_date").isin(dates))
            past = past.where(
                (F.col("service_date") < F.lit(dates[-1]))
                & (F.col("service_date") >= F.date_sub(F.lit(dates[0]), lookback))
            )
        cells = today.select(F.col("service_date").alias("as_of"), *CELL)
        by_day = historical_priors_by_day if histograms is None else priors_of_histograms_by_day
        priors = by_day(past, cells, lookback, min_count)
        priors = priors.withColumnRenamed("as_of", "service_date")
        prior_keys = ["service_date", *CELL]
    rows = route_state(upstream_features(today), strict, exact)
    rows = labelled(rows.join(priors, prior_keys, "left"))
    minute = F.minute(local_time(F.col("observed_arrival_epoch"), zone))
    rows = rows.withColumns(
        {
            "is_peak": is_peak_hour(F.col("hour_of_day")),
            "is_holiday": F.lit(0),
            "minutes_since_service_start": F.col("hour_of_day") * 60 + minute,
            "active_alert_on_route": F.lit(0),
        }
    )
    return join_weather(rows, weather).select(*S.TRAINING_FEATURES_SCHEMA.names)

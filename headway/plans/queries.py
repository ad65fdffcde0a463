"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import (
    clamp_delay,
    csv_row,
    feature_columns,
    fill_rate,
    partition_key,
)
from headway.models import regressor
from headway.operators import analytics, backtest, feed, gold, live, ops, quality, silver
from headway.plans import daily
from headway.plans.warehouse import MIN_CELL, Warehouse
from headway.session import scratch_path, stage
from headway.sinks.tables import (
    export_csv,
    upsert,
    with_row_count,
    write_backtest,
    write_dq,
    write_partitions,
    write_predictions,
)
from headway.sources import adapters
from headway.sources.static import refresh_static
from headway.sources.tables import (
    dim_version,
    load_split,
    read_bronze,
    read_csv_by_name,
    read_dim,
    read_predictions,
    read_weather,
    table_if_present,
)
from headway.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

ROW = list(S.SILVER_KEY)
SILVER_OUT = [n for n in S.STOP_EVENTS_SCHEMA.names if n != "observed_arrival_ts"]
GOLD_OUT = [n for n in S.TRAINING_FEATURES_SCHEMA.names if n != "observed_arrival_ts"]
DQ_MIN_ROWS = 40


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a function of the warehouse under its own name."""
    _QUERIES[fn.__name__] = lambda spark, sf_dir: dates_as_text(fn(Warehouse(spark, sf_dir)))
    return fn


def dates_as_text(df: DataFrame) -> DataFrame:
    """ISO text for dates, so that every client reads the same value."""
    return df.withColumns({n: F.col(n).cast("string") for n, t in df.dtypes if t == "date"})


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: dict[str, int] | int) -> DataFrame:
    """Round doubles so that summation order cannot show."""
    if isinstance(digits, int):
        digits = {n: digits for n, t in df.dtypes if t == "double"}
    return df.withColumns({n: F.round(n, d) for n, d in digits.items() if n in df.columns})


def _silver_out(df: DataFrame) -> DataFrame:
    return rounded(df.select(*SILVER_OUT), {"stop_lat": 6, "stop_lon": 6})


def _valid(w: Warehouse) -> DataFrame:
    return silver.valid_updates(w.trip_updates())


# --- silver ---------------------------------------------------------------------


@query
def silver_latest(w: Warehouse) -> DataFrame:
    return silver.collapse(_valid(w), horizons=())


def _snapshot_query(minutes: int) -> None:
    def run(w: Warehouse) -> DataFrame:
        return silver.snapshot_at(_valid(w), minutes)

    run.__name__ = f"silver_snapshot_{minutes}"
    query(run)


for _minutes in S.HORIZONS:
    _snapshot_query(_minutes)


@query
def silver_schedule(w: Warehouse) -> DataFrame:
    events = silver.collapse(_valid(w), horizons=())
    return silver.join_schedule(events, w.dims()["stop_times"]).select(
        *S.KEY, "scheduled_arrival", "shape_dist_traveled"
    )


@query
def silver_route_recovery(w: Warehouse) -> DataFrame:
    events = silver.collapse(_valid(w), horizons=()).withColumn("feed_route_id", F.col("route_id"))
    return silver.recover_route(events, w.dims()["trips"]).select(
        *S.KEY, "feed_route_id", "route_id"
    )


@query
def silver_enriched(w: Warehouse) -> DataFrame:
    return _silver_out(w.fresh_silver())


@query
def silver_terminus(w: Warehouse) -> DataFrame:
    return w.silver().select(*ROW, "stops_remaining", "is_terminus")


@query
def silver_clamped(w: Warehouse) -> DataFrame:
    events = silver.collapse(_valid(w), horizons=()).withColumn(
        "reported_delay_sec", F.col(S.TARGET)
    )
    return silver.derive(events).select(*ROW, S.TARGET, "reported_delay_sec")


@query
def silver_upsert(w: Warehouse) -> DataFrame:
    """Mornings first, then the rest of every day merged in, then the same batch again."""
    path = scratch_path(w.spark, "silver-table")
    updates, dims = w.trip_updates(), w.dims()
    early = silver.build_silver(updates.where("hour < '12'"), **dims, leads=True)
    late = stage(silver.build_silver(updates.where("hour >= '12'"), **dims, leads=True), "late")
    for batch in (early, late, late):
        silver.upsert_silver(w.spark, path, batch)
    return _silver_out(w.spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path))


@query
def silver_merge_whole_row(w: Warehouse) -> DataFrame:
    """The same halves where the newer row replaces the older one as a whole."""
    path = scratch_path(w.spark, "silver-rows")
    updates, dims = w.trip_updates(), w.dims()
    for half in ("hour < '12'", "hour >= '12'"):
        batch = silver.build_silver(updates.where(half), **dims)
        upsert(w.spark, path, batch, ROW, "last_seen_ts", "service_date")
    return _silver_out(w.spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path))


# --- gold -----------------------------------------------------------------------


def _last_day(df: DataFrame):
    return df.agg(F.max("service_date")).first()[0]


@query
def gold_priors(w: Warehouse) -> DataFrame:
    rows = w.silver()
    days = rows.select(F.col("service_date").alias("as_of"))
    return rounded(gold.historical_priors_by_day(rows, days, min_count=MIN_CELL), 4)


@query
def gold_priors_run_date(w: Warehouse) -> DataFrame:
    rows = w.silver()
    return rounded(gold.historical_priors(rows, _last_day(rows), min_count=MIN_CELL), 4)


@query
def gold_priors_kept(w: Warehouse) -> DataFrame:
    """Priors of the last day from kept daily histograms: all days but the last two written once,
    the last three then as two runs would, each replacing the dates it touched."""
    path, rows = scratch_path(w.spark, "histograms"), w.silver()
    last = _last_day(rows)
    at = F.col("service_date")
    early = rows.where(at < F.date_sub(F.lit(last), 1))
    # The third day from the end lacks its afternoon at first, as if that landed a day later.
    write_partitions(gold.daily_histograms(
        early.where((at < F.date_sub(F.lit(last), 2)) | (F.col("hour_of_day") < 12))), path, ["service_date"])
    for first in (2, 1):
        touched = rows.where(at.isin([last - timedelta(days=first), last - timedelta(days=first - 1)]))
        write_partitions(gold.daily_histograms(touched), path, ["service_date"])
    kept = w.spark.read.schema(S.HISTOGRAM_SCHEMA).parquet(path)
    return rounded(gold.priors_of_histograms(kept, last, min_count=MIN_CELL), 4)


@query
def backfill_days(w: Warehouse) -> DataFrame:
    """Gold of the newest ten days in one plan; days with fewer rows than the mean day fail."""
    rows = w.silver()
    last, least = rows.agg(
        F.max("service_date"), F.ceil(F.count(F.lit(1)) / F.count_distinct("service_date"))
    ).first()
    _, features = daily.gated_features(
        rows, last - timedelta(days=9), last, (least, 0.0, S.DQ_MIN_UNIQUE), w.weather(), min_cell=MIN_CELL
    )
    out = features.select(*ROW, S.TARGET, "prev_stop_delay", "upstream_delay_same_trip", "preceding_trip_delay",
                          "mean_route_delay_15m", "hist_median_delay", "hist_n", "temp_c")
    return rounded(out, 6)


@query
def gold_prev_stop(w: Warehouse) -> DataFrame:
    return gold.upstream_features(w.silver()).select(*ROW, "prev_stop_delay")


@query
def gold_upstream_mean(w: Warehouse) -> DataFrame:
    return rounded(
        gold.upstream_features(w.silver()).select(*ROW, "upstream_delay_same_trip"), 6
    )


@query
def gold_preceding_trip(w: Warehouse) -> DataFrame:
    return gold.upstream_features(w.silver()).select(*ROW, "preceding_trip_delay")


ROUTE_STATE = ("mean_route_delay_15m", "vehicles_active_on_route")


@query
def gold_route_hour(w: Warehouse) -> DataFrame:
    return rounded(gold.route_state(w.silver(), exact=True).select(*ROW, *ROUTE_STATE), 6)


@query
def gold_route_strict(w: Warehouse) -> DataFrame:
    rows = gold.route_state(w.silver(), strict=True, exact=True)
    return rounded(rows.select(*ROW, *ROUTE_STATE), 6)


@query
def approx_vehicles(w: Warehouse) -> DataFrame:
    return rounded(gold.route_state(w.silver()).select(*ROW, *ROUTE_STATE), 6)


@query
def gold_weather_join(w: Warehouse) -> DataFrame:
    return rounded(
        gold.join_weather(w.silver(), w.weather()).select(*ROW, *S.WEATHER_FALLBACK), 6
    )


@query
def gold_weather_stored(w: Warehouse) -> DataFrame:
    """The same join over weather stored as CSV with a header, read by its declared schema."""
    path = scratch_path(w.spark, "weather-csv")
    export_csv(w.weather().select(*S.WEATHER_SCHEMA.names), path)
    stored = read_weather(w.spark, path, "csv")
    return rounded(gold.join_weather(w.silver(), stored).select(*ROW, *S.WEATHER_FALLBACK), 6)


@query
def gold_weather_absent(w: Warehouse) -> DataFrame:
    """Without a weather table in the catalog every row takes the defaults."""
    absent = table_if_present(w.spark, "headway_no_weather")
    return gold.join_weather(w.silver(), absent).select(*ROW, *S.WEATHER_FALLBACK)


@query
def training_split(w: Warehouse) -> DataFrame:
    """Vectors and labels of the training split, read back from the stored splits."""
    path = scratch_path(w.spark, "splits")
    write_partitions(backtest.time_split(w.gold()), path, ["split"])
    return rounded(load_split(w.spark, path, "train", ROW), 4)


@query
def gold_features(w: Warehouse) -> DataFrame:
    out = w.fresh_gold().select(*GOLD_OUT)
    digits = {n: 6 for n, t in out.dtypes if t == "double"}
    return rounded(out, {**digits, "hist_std_delay": 4})


@query
def feature_vector(w: Warehouse) -> DataFrame:
    return rounded(feature_columns(w.gold(), ROW), 4)


@query
def feature_csv(w: Warehouse) -> DataFrame:
    cols = [F.col(n) for n in S.FEATURE_NAMES]
    return feature_columns(w.gold(), ROW).select(*ROW, csv_row(cols).alias("csv"))


@query
def feature_fill_rate(w: Warehouse) -> DataFrame:
    rows = w.gold()
    return rounded(rows.select(*ROW, fill_rate(rows).alias("fill_rate")), 6)


_QUERIES["fill_rate"] = _QUERIES.pop("feature_fill_rate")


@query
def feature_mismatches(w: Warehouse) -> DataFrame:
    """Offline features against a consumer that took the 5-minute snapshot by mistake."""
    offline = w.gold()
    online = offline.withColumn("delay_t_minus_15", F.col("delay_t_minus_5"))
    return quality.feature_mismatches(offline, online, ROW)


def _both_paths(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Gold rows, and what scoring would have read at the moment of each row's own snapshot."""
    offline = w.gold().where("route_id IS NOT NULL AND snap_ts_t_minus_15 IS NOT NULL")
    asked = offline.select(*ROW, "route_id", F.col("snap_ts_t_minus_15").alias("asked_at"))
    days = asked.select(F.to_date(F.timestamp_seconds("asked_at")).alias("as_of"))
    priors = gold.historical_priors_by_day(w.silver(), days, min_count=MIN_CELL)
    return offline, live.replayed_features(asked, _both_feeds(w), priors)


@query
def replayed_mismatches(w: Warehouse) -> DataFrame:
    """Every feature that differs between a stored row and live state as it was then."""
    return rounded(quality.feature_mismatches(*_both_paths(w), ROW), 4)


@query
def feature_parity(w: Warehouse) -> DataFrame:
    return rounded(quality.feature_parity(*_both_paths(w), ROW), 4)


@query
def uncovered_features(w: Warehouse) -> DataFrame:
    return quality.uncovered(w.silver())


# --- quality --------------------------------------------------------------------


@query
def dq_stats(w: Warehouse) -> DataFrame:
    return quality.dq_stats(w.silver(), by=["service_date"])


@query
def dq_rules(w: Warehouse) -> DataFrame:
    return quality.dq_rules(w.silver(), min_rows=DQ_MIN_ROWS, by=["service_date"])


@query
def hourly_landing(w: Warehouse) -> DataFrame:
    return quality.hourly_landing(w.trip_updates())


@query
def trip_id_match(w: Warehouse) -> DataFrame:
    return quality.trip_id_match(w.trip_updates(), w.dims()["trips"])


@query
def trip_id_unmatched(w: Warehouse) -> DataFrame:
    return quality.trip_id_unmatched(w.trip_updates(), w.dims()["trips"])


def _both_feeds(w: Warehouse) -> DataFrame:
    return w.trip_updates().unionByName(w.vehicle_positions(), allowMissingColumns=True)


@query
def ingest_counts(w: Warehouse) -> DataFrame:
    return quality.ingest_counts(_both_feeds(w))


@query
def dedupe_check(w: Warehouse) -> DataFrame:
    return quality.dedupe_check(w.silver())


@query
def coverage(w: Warehouse) -> DataFrame:
    return quality.coverage(w.silver())


@query
def completeness(w: Warehouse) -> DataFrame:
    return quality.completeness(w.gold())


@query
def null_rates(w: Warehouse) -> DataFrame:
    return rounded(quality.null_rates(w.gold()), 6)


@query
def feature_distincts(w: Warehouse) -> DataFrame:
    """Different values per feature from stored daily sketches, beside the exact numbers."""
    rows = w.gold()
    stored = stage(quality.distinct_sketches(rows, ["service_date"], S.FEATURE_NAMES), "feature-sketches")
    exact = rows.agg(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.count_distinct(n).alias("distinct_values")) for n in S.FEATURE_NAMES
    ]).alias("_all")).select(F.inline("_all"))
    estimates = quality.distinct_estimates(stored, ["feature"]).withColumnRenamed("distinct_values", "estimate")
    return exact.join(estimates, "feature").select(
        "feature", "distinct_values",
        quality.within_error(F.col("estimate"), F.col("distinct_values")).alias("within"),
    )


@query
def route_vehicles(w: Warehouse) -> DataFrame:
    """Vehicles per route over all days from stored daily sketches, beside the exact numbers."""
    rows = w.silver().where(F.col("route_id").isNotNull())
    days = quality.distinct_sketches(rows, ["service_date", "route_id"], ["vehicle_id"])
    estimates = quality.distinct_estimates(stage(days, "vehicle-sketches"), ["route_id"])
    exact = rows.groupBy("route_id").agg(F.count_distinct("vehicle_id").alias("vehicles"))
    return exact.join(estimates, "route_id").select(
        "route_id", "vehicles", quality.within_error(F.col("distinct_values"), F.col("vehicles")).alias("within")
    )


@query
def recent_days(w: Warehouse) -> DataFrame:
    return quality.recent_days(w.silver(), min_events=DQ_MIN_ROWS)


@query
def gold_days(w: Warehouse) -> DataFrame:
    return quality.gold_days(w.gold())


@query
def layer_diff(w: Warehouse) -> DataFrame:
    """Silver against a gold table that is one day off."""
    shifted = w.gold().withColumn("service_date", F.date_add("service_date", 1))
    return quality.layer_diff(w.silver(), shifted)


@query
def collection_progress(w: Warehouse) -> DataFrame:
    return rounded(quality.collection_progress(w.silver()), 6)


# --- profiles and baselines -------------------------------------------------------


@query
def delay_distribution(w: Warehouse) -> DataFrame:
    return analytics.delay_distribution(w.silver())


@query
def distribution_share(w: Warehouse) -> DataFrame:
    return rounded(analytics.distribution_share(w.silver()), 6)


@query
def hour_profile(w: Warehouse) -> DataFrame:
    return analytics.hour_profile(w.silver())


@query
def local_hour_profile(w: Warehouse) -> DataFrame:
    return analytics.hour_profile(w.silver(), offset=-7)


@query
def worst_hour(w: Warehouse) -> DataFrame:
    return analytics.worst_hour(analytics.hour_profile(w.silver()))


@query
def baselines_silver(w: Warehouse) -> DataFrame:
    return analytics.silver_baselines(w.silver())


@query
def baselines_gold(w: Warehouse) -> DataFrame:
    return rounded(analytics.baselines(w.gold()), 6)


@query
def baselines_last_14_days(w: Warehouse) -> DataFrame:
    rows = w.gold()
    return rounded(analytics.baselines(rows, as_of=_last_day(rows), days=14), 6)


@query
def historical_baseline(w: Warehouse) -> DataFrame:
    return analytics.historical_baseline(w.gold())


@query
def baseline_gain(w: Warehouse) -> DataFrame:
    return rounded(analytics.baseline_gain(w.silver()), 6)


# --- backtest and evaluation ------------------------------------------------------


@query
def backtest_metrics(w: Warehouse) -> DataFrame:
    return backtest.backtest(w.predictions(), w.silver())


def _daily_metrics(w: Warehouse) -> DataFrame:
    return backtest.backtest(w.predictions(), w.silver(), by=["service_date"])


@query
def backtest_daily(w: Warehouse) -> DataFrame:
    return _daily_metrics(w)


@query
def metric_summary(w: Warehouse) -> DataFrame:
    points = backtest.metric_points(_daily_metrics(w), ["service_date"])
    return rounded(ops.metric_summary(points), {"total": 3})


@query
def model_degraded(w: Warehouse) -> DataFrame:
    return ops.degraded(_daily_metrics(w), limit=0.95)


def _scored(w: Warehouse) -> DataFrame:
    guess = F.round(0.8 * F.coalesce("delay_t_minus_15", F.lit(0)), 1)
    return w.gold().withColumn("predicted_delay_sec", guess)


@query
def evaluation_report(w: Warehouse) -> DataFrame:
    return rounded(backtest.evaluation_report(_scored(w)), 4)


@query
def time_split(w: Warehouse) -> DataFrame:
    return backtest.time_split(w.gold()).select(*ROW, "split")


_models: dict[tuple[str, str], regressor.Boosted] = {}


def _model(w: Warehouse) -> regressor.Boosted:
    """Fitted with the published settings, once per session and data folder."""
    key = (w.spark.sparkContext.applicationId, w.sf_dir)
    if key not in _models:
        split = backtest.time_split(w.gold())
        _models[key] = regressor.train(split.where("split = 'train'"),
                                       validation=split.where("split = 'validation'"))
    return _models[key]


@query
def gbt_predictions(w: Warehouse) -> DataFrame:
    scored = regressor.predict(backtest.time_split(w.gold()), _model(w))
    return rounded(scored.select(*ROW, "split", S.TARGET, "predicted_delay_sec"), 1)


@query
def gbt_stumps(w: Warehouse) -> DataFrame:
    """Two rounds of one split each on all rows and features: what SQL can follow."""
    split = backtest.time_split(w.gold())
    params = regressor.TrainParams(max_depth=1, eta=0.5, subsample=1.0, colsample=1.0, rounds=2)
    model = regressor.train(split.where("split = 'train'"), params)
    return rounded(regressor.predict(split, model).select(*ROW, "split", "predicted_delay_sec"), 3)


@query
def gbt_scores(w: Warehouse) -> DataFrame:
    stops, routes, priors, now = _live_inputs(w)
    scored = regressor.score(_requests(w), stops, routes, priors, _model(w), now)
    return rounded(
        scored.select("route_id", "stop_id", "predicted_delay_sec",
                      F.col("delay_t_minus_15").alias("baseline_delay_sec"), "feature_fill_rate"),
        3,
    )


# --- feed and stream rows -----------------------------------------------------------


@query
def flatten_trip_updates(w: Warehouse) -> DataFrame:
    return feed.flatten_trip_updates(adapters.feed_messages(w.spark, w.sf_dir))


@query
def flatten_vehicle_positions(w: Warehouse) -> DataFrame:
    rows = feed.flatten_vehicle_positions(adapters.feed_messages(w.spark, w.sf_dir))
    return rounded(rows, {"latitude": 6, "longitude": 6})


@query
def pack_unpack(w: Warehouse) -> DataFrame:
    rows = w.trip_updates().select(*S.TRIP_UPDATES_ROW.names)
    lines = feed.unpack_rows(feed.pack_rows(rows).select("value"))
    good, _ = feed.parse_rows(lines, S.TRIP_UPDATES_ROW)
    return good


@query
def partition_keys(w: Warehouse) -> DataFrame:
    return w.trip_updates().groupBy(partition_key().alias("partition_key")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# --- live state -----------------------------------------------------------------------

STATE_OUT = ["pk", "sk", "route_id", "stop_id", "current_delay", "trip_id", "stop_sequence",
             "updated_at"]
ROUTE_OUT = ["pk", "sk", "route_id", *ROUTE_STATE]


def _newest(w: Warehouse) -> int:
    """The feed's own clock: the time of its newest row."""
    return w.trip_updates().agg(F.max("ingest_ts")).first()[0]


def _requests(w: Warehouse) -> DataFrame:
    """One request for every stop that a route is seen at."""
    stops = F.array(*[F.lit(s) for s in adapters.STOPS])
    stop = F.element_at(stops, F.col("current_stop_sequence")).alias("stop_id")
    return w.vehicle_positions().select("route_id", stop).distinct()


def _live_inputs(w: Warehouse):
    now = F.lit(_newest(w))
    rows = _both_feeds(w)
    priors = gold.historical_priors(w.silver(), _last_day(w.silver()), min_count=MIN_CELL)
    return (
        live.stop_state(rows, now), live.route_state_batch(rows, now),
        live.prior_state(priors), now,
    )


@query
def live_stop_state(w: Warehouse) -> DataFrame:
    return live.stop_state(w.trip_updates()).select(*STATE_OUT)


@query
def live_route_state(w: Warehouse) -> DataFrame:
    return live.route_state_batch(_both_feeds(w)).select(*ROUTE_OUT)


@query
def live_state_alive(w: Warehouse) -> DataFrame:
    """State whose last update is no older than its lifetime when the feed ends."""
    state = live.stop_state(w.trip_updates())
    kept = state.withColumn("ttl", F.col("updated_at") + S.STATE_TTL_SECONDS)
    return live.alive(kept, _newest(w)).select("pk", "current_delay", "updated_at")


@query
def live_upstream_state(w: Warehouse) -> DataFrame:
    state = live.with_upstream_state(live.stop_state(w.trip_updates()))
    return rounded(state.select("pk", "prev_stop_delay", "upstream_delay"), 6)


@query
def prior_state(w: Warehouse) -> DataFrame:
    rows = w.silver()
    priors = gold.historical_priors(rows, _last_day(rows), min_count=MIN_CELL)
    return rounded(
        live.prior_state(priors).select(
            "pk", "sk", "hist_median_delay", "hist_p90_delay", "hist_std_delay", "hist_n"
        ),
        4,
    )


@query
def score_features(w: Warehouse) -> DataFrame:
    stops, routes, priors, now = _live_inputs(w)
    source = live.request_features(_requests(w), stops, routes, priors, now)
    return source.select(
        "route_id", "stop_id", "hour_of_day", "day_of_week", "is_weekend", "stop_sequence",
        "delay_t_minus_15", *ROUTE_STATE, "hist_median_delay", "hist_n",
    )


# --- streams: a whole run of the query over packed records of the feed ----------------


def _pack(rows: DataFrame, path: str) -> None:
    """Add packed records of ``rows`` to the folder, with a malformed line each."""
    broken = F.concat("value", F.lit('{"record_type": "trip_upd\n'))
    feed.pack_rows(rows).withColumn("value", broken).write.mode("append").parquet(path)


def _packed(w: Warehouse, rows: DataFrame) -> str:
    """Packed records of ``rows`` as a folder to stream from."""
    path = scratch_path(w.spark, "packed")
    _pack(rows, path)
    return path


ONCE = {"availableNow": True}


def _live_stream(w: Warehouse, kind: str) -> DataFrame:
    columns = list(S.LIVE_ROW.names)
    stream = streams.stream_rows(w.spark, _packed(w, _both_feeds(w).select(*columns)))
    path, checkpoint = scratch_path(w.spark, "state"), scratch_path(w.spark, "state-log")
    running = streams.start_live_state(
        stream, path, checkpoint, trigger=ONCE, clock=F.lit(_newest(w))
    )
    running.awaitTermination()
    return streams.read_state(w.spark, path, kind)


@query
def stream_stop_state(w: Warehouse) -> DataFrame:
    return _live_stream(w, "stops").select(*STATE_OUT)


@query
def stream_route_state(w: Warehouse) -> DataFrame:
    return _live_stream(w, "routes").select(*ROUTE_OUT)


def _runs(w: Warehouse, parts: list[DataFrame], start) -> None:
    """Pack each part after the other into one folder, and run the stream to its end after each."""
    folder = scratch_path(w.spark, "packed")
    for part in parts:
        feed.pack_rows(part.select(*S.TRIP_UPDATES_ROW.names)).write.mode("append").parquet(folder)
        start(streams.stream_rows(w.spark, folder)).awaitTermination()


def _hours(rows: DataFrame, shares: tuple[float, ...]) -> tuple[int, ...]:
    """Times at the given shares of the span that ``rows`` covers."""
    low, high = rows.agg(F.min("ingest_ts"), F.max("ingest_ts")).first()
    return tuple(low + int((high - low) * s) for s in shares)


@query
def stream_state_expiry(w: Warehouse) -> DataFrame:
    """Live state kept by key with expiry: three runs in the order of time, and what is left alive."""
    rows = w.trip_updates()
    one, two = _hours(rows, (0.25, 0.75))
    at = F.col("ingest_ts")
    path, checkpoint = scratch_path(w.spark, "changes"), scratch_path(w.spark, "changes-log")
    _runs(w, [rows.where(at <= one), rows.where((at > one) & (at <= two)), rows.where(at > two)],
          lambda stream: streams.start_stop_changes(stream, path, checkpoint, trigger=ONCE))
    return streams.state_of_changes(w.spark.read.parquet(path)).select(*STATE_OUT)


@query
def stream_route_windows(w: Warehouse) -> DataFrame:
    """Sliding route state: the last four minutes before the middle come twice and count twice;
    what is an hour older than that comes twice too, but behind the watermark."""
    rows = w.trip_updates().where(F.col("route_id").isNotNull())
    (middle,) = _hours(rows, (0.5,))
    at = F.col("ingest_ts")
    before = rows.where(at <= middle)
    (last,) = _hours(before, (1.0,))
    again = before.where((at > last - 240) | (at <= last - 3600))
    path, checkpoint = scratch_path(w.spark, "windows"), scratch_path(w.spark, "windows-log")
    _runs(w, [before, again, rows.where(at > middle)],
          lambda stream: streams.start_route_windows(stream, path, checkpoint, trigger=ONCE, exact=True))
    return rounded(w.spark.read.parquet(path), {"mean_route_delay_15m": 3})


@query
def stream_landing(w: Warehouse) -> DataFrame:
    """Both feeds landed from the stream, stamped with the time in the row as arrival."""
    columns = list(S.BRONZE_ROW.names)
    stream = streams.stream_rows(w.spark, _packed(w, _both_feeds(w).select(*columns)))
    root, checkpoint = scratch_path(w.spark, "bronze"), scratch_path(w.spark, "bronze-log")
    arrived = F.timestamp_seconds("ingest_ts")
    streams.start_landing(stream, root, checkpoint, ONCE, arrived).awaitTermination()
    landed = w.spark.read.parquet(f"{root}/raw")
    return landed.groupBy("record_type", F.col("dt").cast("date").alias("dt")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("trip_id").alias("trips")
    )


@query
def stream_silver(w: Warehouse) -> DataFrame:
    rows = w.trip_updates().select(*S.TRIP_UPDATES_ROW.names)
    # Split by hour: trips then arrive in parts, over several triggers. Each part is packed by as
    # many tasks as read the feed, and a trigger takes as many files as the largest part has.
    part = F.coalesce(F.pmod(F.hour(F.timestamp_seconds("ingest_ts")), F.lit(4)), F.lit(0))
    packed, files = scratch_path(w.spark, "packed"), [0]
    for k in range(4):
        _pack(rows.where(part == k), packed)
        files.append(len(w.spark.read.parquet(packed).inputFiles()))
    largest = max(b - a for a, b in zip(files, files[1:], strict=False))
    stream = streams.stream_rows(w.spark, packed, max_files=largest)
    path, checkpoint = scratch_path(w.spark, "silver-stream"), scratch_path(w.spark, "silver-log")
    streams.start_silver(stream, path, checkpoint, w.dims(), ONCE).awaitTermination()
    return _silver_out(w.spark.read.schema(S.STOP_EVENTS_SCHEMA).parquet(path))


# --- stored results, read back ------------------------------------------------------------


BRONZE_OUT = ["trip_id", "route_id", "stop_id", "ingest_ts", "arrival_time", "arrival_delay"]


@query
def bronze_day_scan(w: Warehouse) -> DataFrame:
    """The partitions of all landing days, found by their dates in one scan."""
    path = scratch_path(w.spark, "bronze-table")
    write_partitions(_both_feeds(w), path, ["record_type", "dt", "hour"])
    days = [r["dt"] for r in w.trip_updates().select("dt").distinct().collect()]
    return read_bronze(w.spark, path, "trip_updates", days).select(*BRONZE_OUT, "dt", "hour")


@query
def static_versions(w: Warehouse) -> DataFrame:
    """Two refreshes, the second with other routes only: what each version reads, and from where."""
    source, target = scratch_path(w.spark, "published"), scratch_path(w.spark, "static")
    dims = w.dims()
    for version in ("v1", "v2"):
        for name, rows in dims.items():
            if name == "routes" and version == "v2":
                rows = rows.withColumn("route_short_name", F.concat("route_short_name", F.lit(" v2")))
            if version == "v1" or name == "routes":
                rows.write.mode("overwrite").option("header", "true").csv(f"{source}/{name}.txt")
        refresh_static(w.spark, source, target, version)
    parts = [
        read_dim(w.spark, target, version, name).agg(
            F.lit(version).alias("version"), F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("route_short_name").endswith(" v2") if name == "routes" else F.lit(False)).alias("changed"),
            F.lit(dim_version(w.spark, target, version, name)).alias("held_in"),
        )
        for version in ("v1", "v2") for name in dims
    ]
    return reduce(DataFrame.union, parts)


@query
def captured_day(w: Warehouse) -> DataFrame:
    """Predictions captured by day, the newest day's twice, read back for that day and the one before."""
    root, rows = scratch_path(w.spark, "captured"), w.predictions()
    (last,) = rows.agg(F.max("service_date")).first()
    days = [last, last - timedelta(days=1)]
    for day in (*days, last):
        write_predictions(rows.where(F.col("service_date") == F.lit(day)), root, "model", str(day))
    return reduce(DataFrame.union, [
        read_predictions(w.spark, root, day).groupBy("service_date", "route_id").agg(
            F.count(F.lit(1)).alias("rows"), F.round(F.sum("predicted_delay_sec"), 1).alias("total")
        ) for day in days
    ])


@query
def silver_csv(w: Warehouse) -> DataFrame:
    """Exported with a header, and bound by name again as text."""
    columns = ["observed_delay_sec", *ROW, "route_id"]
    path = scratch_path(w.spark, "silver-csv")
    export_csv(w.silver().select(*columns), path)
    return read_csv_by_name(w.spark, path, sorted(columns))


@query
def observed_rows(w: Warehouse) -> DataFrame:
    """The number of rows that a write counted on its way."""
    counted, seen = with_row_count(w.silver(), "silver-rows")
    write_partitions(counted, scratch_path(w.spark, "counted"), ["service_date"])
    return w.spark.createDataFrame([(seen.get["rows"],)], "rows long")


@query
def dq_document(w: Warehouse) -> DataFrame:
    path, day = scratch_path(w.spark, "dq"), _last_day(w.silver())
    write_dq(quality.dq_rules(gold.day(w.silver(), day), min_rows=DQ_MIN_ROWS), path, str(day))
    schema = "rule string, passed boolean, observed string, expected string, value double, dt string"
    return w.spark.read.schema(schema).json(path)


@query
def backtest_document(w: Warehouse) -> DataFrame:
    path, day = scratch_path(w.spark, "backtest"), _last_day(w.silver())
    metrics = backtest.backtest(w.predictions(), w.silver())
    write_backtest(metrics, path, str(day))
    fields = ", ".join(f"{n} {t}" for n, t in metrics.dtypes)
    return w.spark.read.schema(f"{fields}, run_date string, dt string").json(path)


@query
def clamped_delays(w: Warehouse) -> DataFrame:
    text = F.col("arrival_delay").cast("string")
    return w.trip_updates().select("trip_id", "stop_id", "ingest_ts", clamp_delay(text).alias("delay"))


# --- operations -------------------------------------------------------------------------


@query
def ingest_windows(w: Warehouse) -> DataFrame:
    rows = w.trip_updates()
    first, last = rows.agg(F.min("ingest_ts"), F.max("ingest_ts")).first()
    start, end = (datetime.fromtimestamp(t, UTC) for t in (first, last + 1))
    return ops.ingest_windows(rows, start, end, min_rows=3)


def _run_span(w: Warehouse):
    runs = adapters.run_log(w.spark, w.sf_dir)
    span = adapters.events(w.spark, w.sf_dir).selectExpr(
        "min(cast(ts AS date))", "max(cast(ts AS date))"
    ).first()
    return runs, span[0], span[1]


@query
def missing_runs(w: Warehouse) -> DataFrame:
    return ops.missing_runs(*_run_span(w))


@query
def run_status(w: Warehouse) -> DataFrame:
    return ops.run_status(*_run_span(w))


@query
def cost_daily(w: Warehouse) -> DataFrame:
    return rounded(ops.cost_daily(w.cost_items()), 9)


@query
def cost_totals(w: Warehouse) -> DataFrame:
    return rounded(ops.cost_totals(ops.cost_daily(w.cost_items())), 9)


@query
def cost_delta(w: Warehouse) -> DataFrame:
    return rounded(ops.cost_delta(ops.cost_daily(w.cost_items())), 9)


@query
def cost_movers(w: Warehouse) -> DataFrame:
    """The services that moved most against the day before, ranked by absolute change."""
    return rounded(ops.cost_movers(ops.cost_delta(ops.cost_daily(w.cost_items())), k=2), 9)


@query
def cost_top_services(w: Warehouse) -> DataFrame:
    return rounded(ops.top_services(ops.cost_daily(w.cost_items())), 9)


@query
def cost_run_rate(w: Warehouse) -> DataFrame:
    return rounded(ops.cost_run_rate(ops.cost_daily(w.cost_items())), 9)


@query
def cost_verdict(w: Warehouse) -> DataFrame:
    rate = ops.cost_run_rate(ops.cost_daily(w.cost_items()))
    return rounded(ops.cost_verdict(rate, daily_max=5, monthly_max=130), 9)


@query
def cost_drivers(w: Warehouse) -> DataFrame:
    return rounded(ops.cost_drivers(ops.cost_daily(w.cost_items())), 9)


@query
def cost_credits(w: Warehouse) -> DataFrame:
    return rounded(ops.credits(w.cost_items()), 9)

"""The given tables read as a transit feed.

Every adapter scales with its table: trips and routes are blocks of users, so the number
of keys grows with the number of users, and the dimensions are derived from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S

# Users per trip and per route, and the order of stops along a trip.
USERS_PER_TRIP = 12
USERS_PER_ROUTE = 48
STOPS = ("signup", "view", "click", "purchase", "error")

_TRIP = f"concat('T', lpad(cast(user_id div {USERS_PER_TRIP} AS string), 9, '0'))"
_ROUTE = f"concat('R', lpad(cast(user_id div {USERS_PER_ROUTE} AS string), 9, '0'))"
_STOP_LIST = ", ".join(f"'{s}'" for s in STOPS)
_SEQUENCE = f"cast(array_position(array({_STOP_LIST}), event_type) AS int)"
_EPOCH = "unix_seconds(cast(ts AS timestamp))"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze predictions: each event is one prediction for a trip at a stop."""
    return events(spark, sf_dir).selectExpr(
        "'trip_updates' AS record_type",
        f"{_EPOCH} AS feed_timestamp",
        f"{_EPOCH} AS ingest_ts",
        f"{_TRIP} AS trip_id",
        f"CASE WHEN event_id % 97 = 0 THEN NULL ELSE {_ROUTE} END AS route_id",
        "cast(user_id % 2 AS int) AS direction_id",
        "date_format(ts, 'yyyyMMdd') AS start_date",
        "CASE WHEN event_id % 33 = 0 THEN 3 WHEN event_id % 7 = 0 THEN NULL ELSE 0 END"
        " AS schedule_relationship",
        "concat('V', cast(user_id AS string)) AS vehicle_id",
        "event_type AS stop_id",
        f"{_SEQUENCE} AS stop_sequence",
        f"{_EPOCH} + 60 * cast(get_json_object(props, '$.k') AS int) AS arrival_time",
        "cast(value * 30 - 1860 AS int) AS arrival_delay",
        "cast(NULL AS bigint) AS departure_time",
        "cast(NULL AS int) AS departure_delay",
        "date_format(ts, 'yyyy-MM-dd') AS dt",
        "date_format(ts, 'HH') AS hour",
    )


def vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sighting per event."""
    return events(spark, sf_dir).selectExpr(
        "'vehicle_positions' AS record_type",
        f"{_EPOCH} AS feed_timestamp",
        f"{_EPOCH} AS ingest_ts",
        "concat('V', cast(user_id AS string)) AS vehicle_id",
        f"{_TRIP} AS trip_id",
        f"{_ROUTE} AS route_id",
        "49 + user_id / 1000 AS latitude",
        "-123 - user_id / 1000 AS longitude",
        "cast(NULL AS double) AS bearing",
        "value AS speed",
        f"{_SEQUENCE} AS current_stop_sequence",
        "cast(NULL AS int) AS occupancy_status",
        f"{_EPOCH} AS vehicle_timestamp",
        "date_format(ts, 'yyyy-MM-dd') AS dt",
        "date_format(ts, 'HH') AS hour",
    )


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed messages: per event a trip update with two stops, and its vehicle.

    The second stop has no arrival, and every 97th message no route, so that unset
    fields have to come out as NULL.
    """
    return events(spark, sf_dir).selectExpr(
        f"named_struct('timestamp', {_EPOCH}) AS header",
        f"""array(
          named_struct(
            'id', cast(event_id AS string),
            'trip_update', named_struct(
              'trip', named_struct('trip_id', {_TRIP},
                'route_id', CASE WHEN event_id % 97 = 0 THEN '' ELSE {_ROUTE} END,
                'start_date', date_format(ts, 'yyyyMMdd'),
                'direction_id', cast(user_id % 2 AS int),
                'schedule_relationship', CASE WHEN event_id % 33 = 0 THEN 3 END),
              'vehicle', named_struct('id', concat('V', cast(user_id AS string))),
              'stop_time_update', array(
                named_struct('stop_id', event_type, 'stop_sequence', {_SEQUENCE},
                  'arrival', named_struct('time', {_EPOCH} + 600,
                                          'delay', cast(value * 30 - 1860 AS int)),
                  'departure', cast(NULL AS struct<time: bigint, delay: int>)),
                named_struct('stop_id', concat(event_type, '-next'),
                  'stop_sequence', {_SEQUENCE} + 1,
                  'arrival', cast(NULL AS struct<time: bigint, delay: int>),
                  'departure', cast(NULL AS struct<time: bigint, delay: int>)))),
            'vehicle', cast(NULL AS {S.VEHICLE_DDL})),
          named_struct(
            'id', concat('p', cast(event_id AS string)),
            'trip_update', cast(NULL AS {S.TRIP_UPDATE_DDL}),
            'vehicle', named_struct(
              'vehicle', named_struct('id', concat('V', cast(user_id AS string))),
              'trip', named_struct('trip_id', {_TRIP}, 'route_id', ''),
              'position', named_struct('latitude', 49 + user_id / 1000,
                'longitude', -123 - user_id / 1000,
                'bearing', cast(NULL AS double), 'speed', value),
              'current_stop_sequence', {_SEQUENCE},
              'occupancy_status', cast(NULL AS int),
              'timestamp', {_EPOCH}))) AS entity""",
        f"{_EPOCH} + 100 AS ingest_ts",
    )


# --- static dimensions, all text as in the CSV files -------------------------
# Keys are made distinct as the numbers they come from, and only then written out as text.


def _numbers(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(*columns).distinct()


_TRIP_NO = f"user_id div {USERS_PER_TRIP} AS trip_no"
_ROUTE_NO = f"user_id div {USERS_PER_ROUTE} AS route_no"
_TRIP_TEXT = "concat('T', lpad(cast(trip_no AS string), 9, '0')) AS trip_id"
_ROUTE_TEXT = "concat('R', lpad(cast(route_no AS string), 9, '0')) AS route_id"


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir, _ROUTE_NO).selectExpr(
        _ROUTE_TEXT,
        "concat('line ', cast(route_no AS string)) AS route_short_name",
        "'3' AS route_type",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip to route. Every fourth trip is listed twice, the second time under a wrong
    route; every eleventh was added after the schedule was published and is not listed."""
    listed = _numbers(spark, sf_dir, _TRIP_NO, _ROUTE_NO).where("trip_no % 11 <> 10")
    twice = F.when(
        F.col("trip_no") % 4 == 0, F.array(F.lit(False), F.lit(True))
    ).otherwise(F.array(F.lit(False)))
    return listed.withColumn("again", F.explode(twice)).selectExpr(
        _TRIP_TEXT, _ROUTE_TEXT, "again"
    ).selectExpr("trip_id", "if(again, 'RX-duplicate', route_id) AS route_id")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbers(spark, sf_dir, "event_type").selectExpr(
        "event_type AS stop_id",
        f"cast(49 + {_SEQUENCE} / 100 AS string) AS stop_lat",
        f"cast(-123 - {_SEQUENCE} / 100 AS string) AS stop_lon",
    )


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule: each trip at each stop, and for every fifth trip a second visit (a loop)."""
    visits = _numbers(spark, sf_dir, _TRIP_NO, "event_type")
    first = F.expr(_SEQUENCE)
    visits = visits.withColumn(
        "seq",
        F.explode(F.when(F.col("trip_no") % 5 == 0, F.array(first, first - 10))
                  .otherwise(F.array(first))),
    )
    return visits.selectExpr(
        _TRIP_TEXT, "event_type AS stop_id", "cast(seq AS string) AS stop_sequence",
        "concat(cast(20 + seq AS string), ':10:00') AS arrival_time",
        "cast(seq * 1.5D AS string) AS shape_dist_traveled",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather, one reading per stop type in the hour; 05:00 is never reported."""
    return (
        events(spark, sf_dir)
        .selectExpr("cast(date_trunc('HOUR', ts) AS timestamp) AS time", f"{_SEQUENCE} AS s")
        .distinct()
        .where("hour(time) <> 5")
        .selectExpr(
            "time",
            "cast(hour(time) - 2 + s AS double) AS temperature_2m",
            "cast(s AS double) AS precipitation",
            "cast(10 + hour(time) AS double) AS wind_speed_10m",
            "cast(20000 - 100 * s AS double) AS visibility",
        )
    )


def predictions(silver: DataFrame) -> DataFrame:
    """Captured predictions: for every stop but a trip's last, a damped persistence."""
    return silver.where("is_terminus = 0").selectExpr(
        "route_id", "stop_id", "trip_id", "service_date",
        "round(0.8D * coalesce(delay_t_minus_15, 0), 1) AS predicted_delay_sec",
        "cast(delay_t_minus_15 AS double) AS delay_t_minus_15",
    )


def cost_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing lines from orders."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "cast(o_orderdate AS date) AS day",
        "o_orderpriority AS service",
        "CASE o_orderstatus WHEN 'F' THEN 'Usage' WHEN 'O' THEN 'Credit' ELSE 'Tax' END"
        " AS record_type",
        "CASE WHEN o_custkey % 2 = 0 THEN 'transit' END AS project",
        "o_totalprice / 100000 AS amount",
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event day; Sundays were missed, Mondays failed."""
    return (
        events(spark, sf_dir).selectExpr("cast(ts AS date) AS day").distinct()
        .where("dayofweek(day) <> 1")
        .selectExpr(
            "day",
            "CASE WHEN dayofweek(day) = 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status",
            "cast(day AS timestamp) + INTERVAL 140 MINUTES AS started",
            "cast(day AS timestamp) + INTERVAL 148 MINUTES AS ended",
        )
    )

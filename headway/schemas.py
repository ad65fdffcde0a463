"""Declared schemas and domain constants, each stated once."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STR, INT, LONG, DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# ---------------------------------------------------------------------------
# Limits, horizons and the feature contract of the data product.
# ---------------------------------------------------------------------------
DELAY_FLOOR = -1800
DELAY_CEILING = 7200
CANCELED = 3
HORIZONS = (5, 15, 30)
LOOKBACK_DAYS = 28
MIN_CELL_ROWS = 20
PEAK_HOURS = (7, 8, 15, 16, 17)
STATE_TTL_SECONDS = 7200
ROWS_PER_RECORD = 100

DQ_MIN_ROWS = 50_000
DQ_MIN_LABEL = 0.85
DQ_MIN_UNIQUE = 0.999

TARGET_DAYS = 21
MIN_EVENTS_PER_DAY = 150_000
MIN_LABEL_RATE = 0.85

MODEL_GATE = 0.92
DEGRADED_RATIO = 1.0
STALL_ROWS = 1000
STALL_WIDTH = "15 minutes"

DAILY_COST_LIMIT = 1.50
MONTHLY_COST_LIMIT = 45.00
SERVICE_MOVE = 0.25
MIN_LINE_COST = 0.005

TARGET = "observed_delay_sec"

FEATURES: tuple[tuple[str, float], ...] = (
    ("hour_of_day", 12.0),
    ("day_of_week", 3.0),
    ("is_weekend", 0.0),
    ("is_holiday", 0.0),
    ("is_peak", 0.0),
    ("minutes_since_service_start", 480.0),
    ("stop_sequence", 1.0),
    ("stops_remaining", 10.0),
    ("shape_dist_traveled", 0.0),
    ("is_terminus", 0.0),
    ("route_type", 3.0),
    ("hist_median_delay", 0.0),
    ("hist_p90_delay", 0.0),
    ("hist_std_delay", 0.0),
    ("hist_n", 0.0),
    ("delay_t_minus_15", 0.0),
    ("prev_stop_delay", 0.0),
    ("upstream_delay_same_trip", 0.0),
    ("preceding_trip_delay", 0.0),
    ("mean_route_delay_15m", 0.0),
    ("vehicles_active_on_route", 0.0),
    ("temp_c", 10.0),
    ("precipitation_mm", 0.0),
    ("wind_kph", 10.0),
    ("visibility_m", 20000.0),
    ("active_alert_on_route", 0.0),
)
FEATURE_NAMES = tuple(name for name, _ in FEATURES)
FEATURE_DEFAULTS = dict(FEATURES)

STATIC_FILES = (
    "agency", "calendar", "calendar_dates", "routes",
    "shapes", "stop_times", "stops", "trips",
)

# ---------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------
KEY = ("start_date", "trip_id", "stop_id")
SILVER_KEY = ("service_date", "trip_id", "stop_id")

TRIP_UPDATES_ROW = _struct(
    ("record_type", STR), ("feed_timestamp", LONG), ("ingest_ts", LONG),
    ("trip_id", STR), ("route_id", STR), ("direction_id", INT), ("start_date", STR),
    ("schedule_relationship", INT), ("vehicle_id", STR), ("stop_id", STR),
    ("stop_sequence", INT), ("arrival_time", LONG), ("arrival_delay", INT),
    ("departure_time", LONG), ("departure_delay", INT),
)
VEHICLE_POSITIONS_ROW = _struct(
    ("record_type", STR), ("feed_timestamp", LONG), ("ingest_ts", LONG),
    ("vehicle_id", STR), ("trip_id", STR), ("route_id", STR),
    ("latitude", DBL), ("longitude", DBL), ("bearing", DBL), ("speed", DBL),
    ("current_stop_sequence", INT), ("occupancy_status", INT), ("vehicle_timestamp", LONG),
)
_PARTITIONS = [T.StructField("dt", STR), T.StructField("hour", STR)]
TRIP_UPDATES_SCHEMA = T.StructType(TRIP_UPDATES_ROW.fields + _PARTITIONS)
VEHICLE_POSITIONS_SCHEMA = T.StructType(VEHICLE_POSITIONS_ROW.fields + _PARTITIONS)

# One superset for both record types: what the landing stream parses and writes.
BRONZE_ROW = T.StructType(
    TRIP_UPDATES_ROW.fields
    + [f for f in VEHICLE_POSITIONS_ROW.fields if f.name not in TRIP_UPDATES_ROW.names]
)

# Delays arrive as numbers or numeric text, so live state parses them as text.
LIVE_ROW = T.StructType(
    [
        T.StructField(f.name, STR if f.name == "arrival_delay" else f.dataType)
        for f in BRONZE_ROW.fields
    ]
)

# Arrivals per day, cell and delay, kept beside silver; NULL delays are counted too.
HISTOGRAM_SCHEMA = _struct(
    ("route_id", STR), ("stop_id", STR), ("is_weekend", INT), ("hour_of_day", INT),
    (TARGET, INT), ("n", LONG), ("service_date", T.DateType()),
)

# Parts of the nested feed message, as DDL.
TRIP_UPDATE_DDL = (
    "struct<trip: struct<trip_id: string, route_id: string, start_date: string,"
    " direction_id: int, schedule_relationship: int>,"
    " vehicle: struct<id: string>,"
    " stop_time_update: array<struct<stop_id: string, stop_sequence: int,"
    " arrival: struct<time: bigint, delay: int>,"
    " departure: struct<time: bigint, delay: int>>>>"
)
VEHICLE_DDL = (
    "struct<vehicle: struct<id: string>, trip: struct<trip_id: string, route_id: string>,"
    " position: struct<latitude: double, longitude: double, bearing: double, speed: double>,"
    " current_stop_sequence: int, occupancy_status: int, timestamp: bigint>"
)
FEED_MESSAGE_DDL = (
    "header struct<timestamp: bigint>, "
    f"entity array<struct<id: string, trip_update: {TRIP_UPDATE_DDL}, vehicle: {VEHICLE_DDL}>>"
)

# ---------------------------------------------------------------------------
# Static dimensions: headered CSV, every column text, bound by name.
# ---------------------------------------------------------------------------
DIM_COLUMNS: dict[str, tuple[str, ...]] = {
    "routes": (
        "route_id", "agency_id", "route_short_name", "route_long_name", "route_desc",
        "route_type", "route_url", "route_color", "route_text_color",
    ),
    "trips": (
        "route_id", "service_id", "trip_id", "trip_headsign", "trip_short_name",
        "direction_id", "block_id", "shape_id", "wheelchair_accessible", "bikes_allowed",
    ),
    "stops": (
        "stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon", "zone_id",
        "stop_url", "location_type", "parent_station", "wheelchair_boarding",
    ),
    "stop_times": (
        "trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence",
        "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled", "timepoint",
    ),
}
DIM_REQUIRED: dict[str, tuple[str, ...]] = {
    "routes": ("route_id", "route_short_name", "route_type"),
    "trips": ("trip_id", "route_id"),
    "stops": ("stop_id", "stop_lat", "stop_lon"),
    "stop_times": ("trip_id", "stop_id", "stop_sequence", "arrival_time"),
}

# ---------------------------------------------------------------------------
# Silver and gold
# ---------------------------------------------------------------------------
STOP_EVENTS_SCHEMA = _struct(
    ("service_date", T.DateType()), ("trip_id", STR), ("stop_id", STR), ("route_id", STR),
    ("direction_id", INT), ("vehicle_id", STR), ("stop_sequence", INT), ("start_date", STR),
    ("observed_arrival_epoch", LONG), ("observed_arrival_ts", T.TimestampType()),
    ("observed_delay_sec", INT), ("last_seen_ts", LONG),
    ("delay_t_minus_5", INT), ("delay_t_minus_15", INT), ("delay_t_minus_30", INT),
    ("snap_ts_t_minus_5", LONG), ("snap_ts_t_minus_15", LONG), ("snap_ts_t_minus_30", LONG),
    ("scheduled_arrival", STR), ("shape_dist_traveled", DBL), ("stop_lat", DBL),
    ("stop_lon", DBL), ("route_short_name", STR), ("route_type", INT), ("hour_of_day", INT),
    ("day_of_week", INT), ("is_weekend", INT), ("stops_remaining", INT), ("is_terminus", INT),
)
SNAPSHOT_COLUMNS = tuple(
    f"{stem}_t_minus_{h}" for stem in ("delay", "snap_ts") for h in HORIZONS
)

TRAINING_FEATURES_SCHEMA = T.StructType(
    [f for f in STOP_EVENTS_SCHEMA.fields if f.name != "service_date"]
    + _struct(
        ("is_holiday", INT), ("is_peak", INT), ("minutes_since_service_start", INT),
        ("hist_median_delay", INT), ("hist_p90_delay", INT), ("hist_std_delay", DBL),
        ("hist_n", LONG), ("prev_stop_delay", INT), ("upstream_delay_same_trip", DBL),
        ("preceding_trip_delay", INT), ("mean_route_delay_15m", DBL),
        ("vehicles_active_on_route", LONG), ("temp_c", DBL), ("precipitation_mm", DBL),
        ("wind_kph", DBL), ("visibility_m", DBL), ("active_alert_on_route", INT),
    ).fields
    + [T.StructField("service_date", T.DateType())]
)

WEATHER_SCHEMA = _struct(
    ("time", T.TimestampType()), ("temperature_2m", DBL), ("precipitation", DBL),
    ("wind_speed_10m", DBL), ("visibility", DBL),
)
WEATHER_FALLBACK = ("temp_c", "precipitation_mm", "wind_kph", "visibility_m")

PREDICTIONS_SCHEMA = _struct(
    ("route_id", STR), ("stop_id", STR), ("trip_id", STR), ("service_date", STR),
    ("predicted_delay_sec", STR), ("delay_t_minus_15", STR),
)

COST_ITEMS_SCHEMA = _struct(
    ("day", T.DateType()), ("service", STR), ("record_type", STR), ("project", STR),
    ("amount", DBL),
)
RUN_LOG_SCHEMA = _struct(
    ("day", T.DateType()), ("status", STR), ("started", T.TimestampType()),
    ("ended", T.TimestampType()),
)

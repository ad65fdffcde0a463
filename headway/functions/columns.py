"""Column functions. No UDFs: everything stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S


def n_rows() -> Column:
    return F.count(F.lit(1))


def number(value: Column) -> Column:
    """Lenient double: text that is no number, and NaN, become NULL."""
    as_double = value.try_cast("double")
    return F.when(~F.isnan(as_double), as_double)


def clamp_delay(value: Column, lo: int = S.DELAY_FLOOR, hi: int = S.DELAY_CEILING) -> Column:
    """The delay in seconds, or NULL when it is no number or implausible."""
    seconds = number(value)
    return F.when(seconds.between(lo, hi), seconds)


def null_outside(value: Column, lo: int = S.DELAY_FLOOR, hi: int = S.DELAY_CEILING) -> Column:
    """Type-preserving clamp for columns that are numeric already."""
    return F.when(value.between(lo, hi), value)


def plausible(value: Column, lo: int = S.DELAY_FLOOR, hi: int = S.DELAY_CEILING) -> Column:
    """True or false, never NULL."""
    return F.coalesce(number(value).between(lo, hi), F.lit(False))


def is_peak_hour(hour: Column) -> Column:
    return hour.isin(*S.PEAK_HOURS).cast("int")


def weekend(day_of_week: Column) -> Column:
    """1 on Sunday (1) and Saturday (7)."""
    return day_of_week.isin(1, 7).cast("int")


def local_time(epoch: Column, zone: str = "UTC") -> Column:
    """Wall-clock timestamp of an epoch in ``zone``, for hour and weekday features."""
    utc = F.timestamp_seconds(epoch)
    return utc if zone == "UTC" else F.from_utc_timestamp(utc, zone)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def partition_key(route: str = "route_id", vehicle: str = "vehicle_id") -> Column:
    """Stream key: route, else vehicle, else a fixed word."""
    return F.coalesce(
        blank_to_null(F.col(route)), blank_to_null(F.col(vehicle)), F.lit("unknown")
    )


# The seven delay buckets, upper bounds exclusive.
DELAY_BUCKETS = (
    (-300, "1. early >5m"),
    (-60, "2. early 1-5m"),
    (60, "3. on time"),
    (180, "4. late 1-3m"),
    (300, "5. late 3-5m"),
    (600, "6. late 5-10m"),
)
LAST_BUCKET = "7. late >10m"


def delay_bucket(delay: Column) -> Column:
    first_bound, first_label = DELAY_BUCKETS[0]
    chain = F.when(delay < first_bound, first_label)
    for bound, label in DELAY_BUCKETS[1:]:
        chain = chain.when(delay < bound, label)
    return chain.otherwise(LAST_BUCKET)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """NULL where the denominator is zero or NULL."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


# --- the feature contract ---------------------------------------------------


def feature_value(name: str, value: Column) -> Column:
    """One feature as a double, with its default where it is missing or garbage."""
    return F.coalesce(number(value), F.lit(S.FEATURE_DEFAULTS[name])).alias(name)


def feature_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The ordered feature vector of every row; an absent column takes its default."""
    have = set(df.columns)
    vector = [
        feature_value(n, F.col(n)) if n in have else F.lit(S.FEATURE_DEFAULTS[n]).alias(n)
        for n in S.FEATURE_NAMES
    ]
    return df.select(*keep, *vector)


def csv_row(cols: Sequence[Column]) -> Column:
    """Positional row with six decimals; a wrong number of columns is an error."""
    if len(cols) != len(S.FEATURE_NAMES):
        raise ValueError(f"expected {len(S.FEATURE_NAMES)} features, got {len(cols)}")
    return F.concat_ws(",", *[F.format_string("%.6f", c) for c in cols])


def fill_rate(df: DataFrame) -> Column:
    """Share of the contract's features that are present and not NULL in a row."""
    known = [F.col(n).isNotNull().cast("int") for n in S.FEATURE_NAMES if n in df.columns]
    total = sum(known[1:], known[0]) if known else F.lit(0)
    return total / F.lit(float(len(S.FEATURE_NAMES)))


def unpivot(df: DataFrame, keys: Sequence[str], values: Mapping[str, str] | Sequence[str],
            name: str, value: str) -> DataFrame:
    """Long form of some columns; a mapping renames them on the way."""
    names = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    renamed = df.select(*keys, *[F.col(src).alias(dst) for src, dst in names.items()])
    return renamed.unpivot(list(keys), list(names.values()), name, value)

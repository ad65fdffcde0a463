from headway.functions.columns import (
    clamp_delay,
    csv_row,
    delay_bucket,
    feature_columns,
    fill_rate,
    is_peak_hour,
    null_outside,
    number,
    partition_key,
    plausible,
)
from headway.functions.dates import last_days, resolve_run_date

__all__ = [
    "clamp_delay", "csv_row", "delay_bucket", "feature_columns", "fill_rate", "is_peak_hour",
    "last_days", "null_outside", "number", "partition_key", "plausible", "resolve_run_date",
]

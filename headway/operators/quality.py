"""Checks on bronze, silver and gold, each as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import feature_columns, n_rows
from headway.operators.ranges import discrete_quantiles, value_counts

# A NULL in either part makes the pair NULL, and the row counts as a duplicate.
_PAIR = "concat(trip_id, '|', stop_id)"


#: Binary logarithm of a sketch's number of registers: its standard error is 1.04 / 2^6.
SKETCH_LOG = 12


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


# --- bronze -------------------------------------------------------------------


def hourly_landing(feed: DataFrame, d: str | None = None) -> DataFrame:
    """Rows, trips and labelled rows per landing hour."""
    rows = feed if d is None else feed.where(F.col("dt") == d)
    return rows.groupBy("dt", "hour").agg(
        n_rows().alias("rows"),
        F.count_distinct("trip_id").alias("trips"),
        F.count("arrival_delay").alias("labelled"),
    )


def trip_id_match(feed: DataFrame, trips: DataFrame) -> DataFrame:
    """How many rows the feed-to-schedule join has; zero means the ids do not match.

    Counted from per-trip counts of both sides, so the join itself is never built.
    """
    seen = feed.groupBy("trip_id").agg(n_rows().alias("_feed"))
    listed = trips.groupBy("trip_id").agg(n_rows().alias("_listed"))
    total = F.coalesce(F.sum(F.col("_feed") * F.col("_listed")), F.lit(0))
    return seen.join(listed, "trip_id").agg(total.alias("joined_rows"))


def trip_id_unmatched(feed: DataFrame, trips: DataFrame) -> DataFrame:
    """Feed trips that the schedule does not list, with their row counts."""
    seen = feed.where(F.col("trip_id").isNotNull()).groupBy("trip_id").agg(n_rows().alias("rows"))
    return seen.join(trips.select("trip_id").distinct(), "trip_id", "left_anti")


def ingest_counts(feed: DataFrame) -> DataFrame:
    """Rows per record type."""
    return feed.groupBy("record_type").agg(n_rows().alias("rows"))


# --- silver -------------------------------------------------------------------


def dedupe_check(silver: DataFrame, d: date | None = None) -> DataFrame:
    """Events, labels, duplicate (trip, stop) pairs and median delay per service date."""
    rows = silver if d is None else silver.where(F.col("service_date") == F.lit(d))
    stats = rows.groupBy("service_date").agg(
        n_rows().alias("events"),
        F.count(S.TARGET).alias("labelled"),
        (n_rows() - F.count_distinct(F.expr(_PAIR))).alias("dupes"),
    )
    medians = discrete_quantiles(
        value_counts(rows, ["service_date"], S.TARGET), ["service_date"], S.TARGET,
        {"median_delay": 0.5},
    ).drop("total")
    return stats.join(medians, "service_date", "left")


def coverage(silver: DataFrame) -> DataFrame:
    return silver.groupBy("service_date").agg(n_rows().alias("events")).orderBy("service_date")


def collection_progress(silver: DataFrame, target: int = S.TARGET_DAYS) -> DataFrame:
    """Days collected so far and how many are still missing for a time split."""
    return (
        silver.agg(
            F.count_distinct("service_date").alias("days"),
            F.min("service_date").alias("first_day"),
            F.max("service_date").alias("last_day"),
            n_rows().alias("total_events"),
            F.count(S.TARGET).alias("labelled"),
        )
        .withColumn("label_rate", _share(F.col("labelled"), F.col("total_events")))
        .withColumn("remaining", F.greatest(F.lit(0), F.lit(target) - F.col("days")))
    )


def _newest(table: DataFrame, n: int) -> DataFrame:
    """The rows of the newest ``n`` days; days are found first, so no other day is aggregated."""
    days = table.select("service_date").distinct().orderBy(F.col("service_date").desc()).limit(n)
    return table.join(days, "service_date", "left_semi")


def recent_days(silver: DataFrame, n: int = 7, min_events: int = S.MIN_EVENTS_PER_DAY,
                min_label: float = S.MIN_LABEL_RATE) -> DataFrame:
    """The newest ``n`` days with their usability verdicts."""
    if n < 1:
        raise ValueError("at least one day")
    days = _newest(silver, n).groupBy("service_date").agg(
        n_rows().alias("events"),
        F.count(S.TARGET).alias("labelled"),
        F.round(F.count(S.TARGET) / n_rows(), 3).alias("label_rate"),
        (n_rows() - F.count_distinct(F.expr(_PAIR))).alias("dupes"),
    )
    verdicts = {
        "enough_events": F.col("events") >= min_events,
        "enough_labels": F.col("label_rate") >= min_label,
        "no_dupes": F.col("dupes") == 0,
    }
    usable = verdicts["enough_events"] & verdicts["enough_labels"] & verdicts["no_dupes"]
    return days.withColumns({**verdicts, "usable": usable})


def gold_days(gold: DataFrame, n: int = 7) -> DataFrame:
    """Feature rows of the newest days."""
    return _newest(gold, n).groupBy("service_date").agg(n_rows().alias("rows_out"))


# --- the gate -----------------------------------------------------------------


def dq_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Everything the rules need, in one pass; ``by=('service_date',)`` gives every day."""
    return df.groupBy(*by).agg(
        n_rows().alias("rows"),
        F.count("trip_id").alias("trip_ids"),
        F.count(S.TARGET).alias("labelled"),
        F.count_distinct(*S.SILVER_KEY).alias("distinct_keys"),
        F.min(S.TARGET).alias("min_delay"),
        F.max(S.TARGET).alias("max_delay"),
    )


def dq_rules(df: DataFrame, min_rows: int = S.DQ_MIN_ROWS, min_label: float = S.DQ_MIN_LABEL,
             min_unique: float = S.DQ_MIN_UNIQUE, by: Sequence[str] = ()) -> DataFrame:
    """Five rows (rule, passed, observed, expected), all rules always evaluated.

    An empty input fails every rule but the bounds. ``observed`` is text, as in the stored
    document; ``value`` is the same as a number (the bounds rule: the lowest delay).
    """
    rows = F.col("rows")
    label = F.round(_share(F.col("labelled"), rows), 4)
    unique = F.round(_share(F.col("distinct_keys"), rows), 6)
    low, high = F.col("min_delay"), F.col("max_delay")
    in_bounds = F.coalesce(
        (low >= S.DELAY_FLOOR) & (high <= S.DELAY_CEILING), F.lit(True)
    )
    rules = (
        ("row_count_minimum", rows >= min_rows, rows, rows.cast("string"), f">= {min_rows}"),
        ("trip_id_completeness", (rows > 0) & (F.col("trip_ids") == rows),
         F.col("trip_ids"), F.col("trip_ids").cast("string"), rows.cast("string")),
        ("label_completeness", _share(F.col("labelled"), rows) >= min_label,
         label, label.cast("string"), f">= {min_label}"),
        ("key_uniqueness", _share(F.col("distinct_keys"), rows) >= min_unique,
         unique, unique.cast("string"), f">= {min_unique}"),
        ("delay_within_bounds", in_bounds, low,
         F.format_string("[%s, %s]", low, high), f"[{S.DELAY_FLOOR}, {S.DELAY_CEILING}]"),
    )
    as_rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.coalesce(passed, F.lit(False)).alias("passed"),
                text.alias("observed"),
                (F.lit(wanted) if isinstance(wanted, str) else wanted).alias("expected"),
                value.cast("double").alias("value"),
            )
            for name, passed, value, text, wanted in rules
        ]
    )
    return dq_stats(df, by).select(*by, F.inline(as_rows))


def passing_dates(rules: DataFrame) -> DataFrame:
    """The dates none of whose rules failed, as a table; a rule without a verdict fails."""
    verdict = F.every(F.coalesce("passed", F.lit(False)))
    return rules.groupBy("service_date").agg(verdict.alias("_good")).where("_good").select("service_date")


# --- gold ---------------------------------------------------------------------


def completeness(gold: DataFrame) -> DataFrame:
    return gold.agg(
        n_rows().alias("rows"),
        F.count_distinct("service_date").alias("days"),
        F.count_if(F.col("hist_median_delay").isNull()).alias("missing_prior"),
        F.count_if(F.col("delay_t_minus_15").isNull()).alias("missing_snapshot"),
    )


def null_rates(df: DataFrame, d: date | None = None, by: Sequence[str] = ("service_date",),
               features: Sequence[str] = S.FEATURE_NAMES, distinct: bool = False) -> DataFrame:
    """Null share of every feature, and whether it is constant; long form.

    ``distinct`` adds an approximate number of distinct values.
    """
    rows = df if d is None else df.where(F.col("service_date") == F.lit(d))
    have = [f for f in features if f in df.columns]
    stats = []
    for f in have:
        value = F.col(f).cast("double")
        parts = [
            F.lit(f).alias("feature"),
            (F.count_if(value.isNull()) / n_rows()).alias("null_rate"),
            F.coalesce(F.min(value) == F.max(value), F.lit(True)).alias("is_constant"),
        ]
        if distinct:
            parts.append(F.approx_count_distinct(value).alias("distinct_values"))
        stats.append(F.struct(*parts))
    return rows.groupBy(*by).agg(F.array(*stats).alias("_stats")).select(
        *by, F.inline("_stats")
    )


def uncovered(df: DataFrame) -> DataFrame:
    """Contract features that no row of ``df`` ever fills."""
    have = [f for f in S.FEATURE_NAMES if f in df.columns]
    filled = df.agg(*[F.count(f).alias(f) for f in have])
    missing = [
        F.when(F.col(f) == 0, F.lit(f)) if f in have else F.lit(f) for f in S.FEATURE_NAMES
    ]
    return filled.select(F.explode(F.array_compact(F.array(*missing))).alias("feature"))


def _both_vectors(offline: DataFrame, online: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides' vectors of every row that both have, as structs ``_a`` and ``_b``."""
    def packed(df: DataFrame, side: str) -> DataFrame:
        values = F.struct(*[F.col(f).cast("double").alias(f) for f in S.FEATURE_NAMES])
        return feature_columns(df, keys).select(*keys, values.alias(side))

    # Joined wide: what differs is unfolded after the join, not all features before it.
    return packed(offline, "_a").join(packed(online, "_b"), list(keys))


def feature_mismatches(offline: DataFrame, online: DataFrame, keys: Sequence[str],
                       tol: float = 1e-6) -> DataFrame:
    """Features whose offline and online values differ for the same row."""
    each = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f"_a.{f}").alias("offline"),
                 F.col(f"_b.{f}").alias("online"))
        for f in S.FEATURE_NAMES
    ])
    differing = F.filter(each, lambda d: F.abs(d["offline"] - d["online"]) > tol)
    return _both_vectors(offline, online, keys).select(*keys, F.inline(differing))


def feature_parity(offline: DataFrame, online: DataFrame, keys: Sequence[str],
                   tol: float = 1e-6) -> DataFrame:
    """Per feature of the contract: rows compared, rows that differ, and the largest difference."""
    each = []
    for f in S.FEATURE_NAMES:
        gap = F.abs(F.col(f"_a.{f}") - F.col(f"_b.{f}"))
        each.append(F.struct(
            F.lit(f).alias("feature"), n_rows().alias("compared"),
            F.count_if(gap > tol).alias("differing"), F.max(gap).alias("largest"),
        ))
    return _both_vectors(offline, online, keys).agg(F.array(*each).alias("_all")).select(F.inline("_all"))


def layer_diff(silver: DataFrame, gold: DataFrame, counts: bool = True) -> DataFrame:
    """Days that silver and gold do not agree on.

    ``missing``: in silver only; ``orphan``: in gold only; ``partial``: both have the day
    but gold lacks labelled rows (it was built before a later correction).
    """
    s = silver.groupBy("service_date").agg(
        n_rows().alias("silver_rows"), F.count(S.TARGET).alias("silver_labelled")
    )
    g = gold.groupBy("service_date").agg(n_rows().alias("gold_rows"))
    status = F.when(F.col("gold_rows").isNull(), "missing").when(
        F.col("silver_rows").isNull(), "orphan"
    )
    if counts:
        status = status.when(F.col("silver_labelled") != F.col("gold_rows"), "partial")
    both = s.join(g, "service_date", "full").withColumn("status", status)
    return both.where(F.col("status").isNotNull())


def distinct_sketches(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by..., feature, sketch): a mergeable sketch of each column's different values.

    Stored per day, sketches of many days unite into the count over all of them without
    reading the days again. NULLs do not count.
    """
    sketches = [F.struct(F.lit(c).alias("feature"), F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_LOG).alias("sketch"))
                for c in columns]
    return df.groupBy(*by).agg(F.array(*sketches).alias("_stats")).select(*by, F.inline("_stats"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., distinct_values) of united sketches."""
    return sketches.groupBy(*by).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("distinct_values")
    )


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is within three standard errors of the exact count, or off by one."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * 3 * 1.04 / 2 ** (SKETCH_LOG / 2))

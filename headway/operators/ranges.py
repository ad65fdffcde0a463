"""Ordered computations inside groups of any size.

A plain window puts a whole group into one task, which is right where the key bounds the group.
Other groups are cut into chunks along their order: each chunk is windowed on its own, and what
it needs from earlier chunks (last value, running sum and count) comes from one small summary
row per chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_GROUP, _CHUNK = "_group", "_chunk"
_BEFORE = (Window.unboundedPreceding, -1)


def _context(spec: WindowSpec, lag: Mapping[str, str], running: Mapping[str, str]
             ) -> dict[str, Column]:
    earlier = spec.rowsBetween(*_BEFORE)
    columns = {name: F.lag(source).over(spec) for name, source in lag.items()}
    for name, source in running.items():
        columns[f"{name}_sum"] = F.sum(source).over(earlier)
        columns[f"{name}_n"] = F.count(source).over(earlier)
    return columns


def ordered_context(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column | None = None,
    lag: Mapping[str, str] | None = None,
    running: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add values of the earlier rows of each group.

    ``lag``: {new column: source}, the previous row's value, NULL included.
    ``running``: {prefix: source}, adds ``<prefix>_sum`` and ``<prefix>_n`` over all
    earlier rows, NULLs left out. ``order`` must be total within a group and ascending.
    NULL keys form a group of their own.

    ``chunk``, which must never decrease along the order, cuts the groups up; without it a
    group is one window. Give it unless the keys bound the size of a group.
    """
    lag, running = dict(lag or {}), dict(running or {})
    if chunk is None:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns(_context(spec, lag, running))

    # A struct key compares equal on NULL fields, so NULL groups survive the joins, and
    # the join on chunks can reuse the window's partitioning.
    piece = F.coalesce(chunk.cast("bigint"), F.lit(-(2**62)))
    keyed = df.withColumn(_GROUP, F.struct(*keys)).withColumn(_CHUNK, piece)

    inner = Window.partitionBy(_GROUP, _CHUNK).orderBy(*order)
    local = {**_context(inner, lag, running), "_first": F.row_number().over(inner) == 1}

    per_chunk, carried = [], {}
    across = Window.partitionBy(_GROUP).orderBy(_CHUNK)
    for name, source in lag.items():
        tail = F.max(F.struct(*order, F.col(source).alias("_value")))
        per_chunk.append(tail["_value"].alias(f"_{name}"))
        carried[f"_{name}"] = F.lag(f"_{name}").over(across)
    for name, source in running.items():
        per_chunk += [F.sum(source).alias(f"_{name}_sum"), F.count(source).alias(f"_{name}_n")]
        for part in (f"_{name}_sum", f"_{name}_n"):
            carried[part] = F.sum(part).over(across.rowsBetween(*_BEFORE))
    summary = keyed.groupBy(_GROUP, _CHUNK).agg(*per_chunk)
    carry = summary.withColumns(carried)

    joined = keyed.withColumns(local).join(carry, [_GROUP, _CHUNK], "left")
    final = {n: F.when(F.col("_first"), F.col(f"_{n}")).otherwise(F.col(n)) for n in lag}
    for name in running:
        total, count = f"{name}_sum", f"{name}_n"
        final[total] = F.when(
            F.col(total).isNotNull() | F.col(f"_{total}").isNotNull(),
            F.coalesce(F.col(total), F.lit(0)) + F.coalesce(F.col(f"_{total}"), F.lit(0)),
        )
        final[count] = F.col(count) + F.coalesce(F.col(f"_{count}"), F.lit(0))
    return joined.withColumns(final).drop("_first", *carry.columns)


def with_group_values(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Add whole-group aggregates to every row.

    An aggregate and a join instead of a window: the aggregate combines before the
    shuffle, and a hot group's rows can be split by the join. NULL keys match each other.
    """
    keyed = df.withColumn(_GROUP, F.struct(*keys))
    values = keyed.groupBy(_GROUP).agg(*aggregates)
    return keyed.join(values, _GROUP, "left").drop(_GROUP)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None
                 ) -> DataFrame:
    """Histogram: one row per distinct value of a group, with its count ``n``."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("n"))


def discrete_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Exact quantiles from a histogram: the smallest value reaching ceil(p * n) rows.

    ``quantiles``: {column: p}, p in thousandths; ``total`` is the sum of the counts.
    For values of a bounded domain, such as clamped delays: the window then holds at most
    one row per possible value, however many rows the group had.
    """
    group = Window.partitionBy(*keys)
    ranked = counts.withColumns(
        {
            "_upto": F.sum("n").over(group.orderBy(value).rowsBetween(
                Window.unboundedPreceding, Window.currentRow)),
            "_total": F.sum("n").over(group),
        }
    )
    picks = []
    for name, p in quantiles.items():
        needed = F.expr(f"(_total * {round(p * 1000)} + 999) div 1000")
        picks.append(F.min(F.when(F.col("_upto") >= needed, F.col(value))).alias(name))
    return ranked.groupBy(*keys).agg(*picks, F.max("_total").alias("total"), *extra)


def interpolated_quantile(
    df: DataFrame, keys: Sequence[str], value: str, p: float, name: str
) -> DataFrame:
    """Exact quantile with linear interpolation between the two nearest ranks.

    Equal values are counted together before anything moves. Counts per unit-wide chunk of
    the value then tell which chunks hold the wanted ranks, and only those are ranked.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.floor(value).alias(_CHUNK), value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    group = Window.partitionBy(*keys)
    chunks = (
        counts.groupBy(*keys, _CHUNK)
        .agg(F.sum("_n").alias("_in_chunk"))
        .withColumns(
            {
                "_upto": F.sum("_in_chunk").over(group.orderBy(_CHUNK)),
                "_at": F.lit(p) * (F.sum("_in_chunk").over(group) - 1),
            }
        )
        .withColumns(
            {
                "_low": F.floor("_at"),
                "_high": F.ceil("_at"),
                "_base": F.col("_upto") - F.col("_in_chunk"),
            }
        )
    )
    holds = [
        (F.col("_base") <= F.col(rank)) & (F.col(rank) < F.col("_upto"))
        for rank in ("_low", "_high")
    ]
    wanted = chunks.where(holds[0] | holds[1]).drop("_in_chunk", "_upto")
    within = Window.partitionBy(*keys, _CHUNK).orderBy(value)
    ranked = counts.join(wanted, [*keys, _CHUNK]).withColumn(
        "_upto", F.col("_base") + F.sum("_n").over(within)
    )
    low = F.min(F.when(F.col("_upto") > F.col("_low"), F.col(value)))
    high = F.min(F.when(F.col("_upto") > F.col("_high"), F.col(value)))
    part = F.max(F.col("_at") - F.col("_low"))
    return ranked.groupBy(*keys).agg((low + (high - low) * part).alias(name))

"""Writers: partition replacement, conditional upsert, result documents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.session import stage
from headway.sources.tables import read_or_empty


def write_partitions(df: DataFrame, path: str, by: Sequence[str], files: int | None = None,
                     format: str = "parquet") -> None:
    """Replace exactly the partitions that ``df`` holds; all others stay.

    The overwrite mode is set on this write, so it cannot leak into the session. Without
    ``files`` the rows are rebalanced by partition at run time: small partitions become
    one file, and a partition with a large share of the rows is split over several tasks.
    """
    laid_out = df.repartition(files) if files else df.hint("rebalance", *by)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(format)
        .save(path)
    )


def reject_undated(staged: DataFrame, path: str, **run: str | int) -> int:
    """Rows whose start date is no date go to ``path`` under ``run``; returns their number."""
    bad = staged.where(F.col("service_date").isNull()).withColumns(
        {name: F.lit(value) for name, value in run.items()}
    )
    n = bad.count()
    if n:
        write_partitions(bad, path, list(run))
    return n


def with_row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of running the plan a second time."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _newer(version: str | Sequence[str]) -> Column:
    if isinstance(version, str):
        return F.col(f"_s.{version}") > F.col(f"_t.{version}")
    return F.struct(*[F.col(f"_s.{v}") for v in version]) > F.struct(
        *[F.col(f"_t.{v}") for v in version]
    )


def merge_newer(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                version: str | Sequence[str], carry_cols: Sequence[str] = (),
                computed: Mapping[str, Column] | None = None) -> DataFrame:
    """``target`` with ``staged`` merged in.

    A new key is inserted; a known key is replaced as a whole if the staged version is
    strictly newer, and a NULL version never is. ``carry_cols`` keep their old value where
    the newer row has none. Several version columns compare in order. ``staged`` holds
    each key once. ``computed`` gives some columns as expressions over both sides' rows,
    the structs ``_t`` and ``_s``, whichever row is taken.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_t"))
    s = staged.select(*keys, F.struct(*rest).alias("_s"))
    take = F.col("_t").isNull() | (F.col("_s").isNotNull() & F.coalesce(_newer(version), F.lit(False)))
    picked = []
    for c in rest:
        if computed and c in computed:
            picked.append(computed[c].alias(c))
            continue
        fresh, old = F.col(f"_s.{c}"), F.col(f"_t.{c}")
        if c in carry_cols:
            fresh = F.coalesce(fresh, old)
        picked.append(F.when(take, fresh).otherwise(old).alias(c))
    return t.join(s, list(keys), "full").select(*keys, *picked).select(*columns)


def upsert(spark: SparkSession, path: str, staged: DataFrame, keys: Sequence[str],
           version: str | Sequence[str], partition_by: str, carry_cols: Sequence[str] = ()
           ) -> list:
    """Merge ``staged`` into the table at ``path``; returns the partition values touched.

    Only touched partitions are read and rewritten. The staged rows are written down
    first, so their plan runs once, and a repeated run changes nothing. The overwrite
    replaces a partition only when its new files are complete; a failure inside the commit
    itself can lose a touched partition, which the run repeated from its source makes anew.
    The partition column is part of the key or determined by it.
    """
    return upsert_with(
        spark, path, staged, partition_by,
        lambda target, rows: merge_newer(target, rows, keys, version, carry_cols),
    )


def upsert_with(spark: SparkSession, path: str, staged: DataFrame, partition_by: str,
                merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list:
    """Write ``merge(target, staged)`` over the partitions that ``staged`` touches.

    A NULL partition value raises: its rows would replace the default partition, whose old
    rows no comparison selects.
    """
    staged = stage(staged, "upsert")
    # One value per partition of the table, not per row.
    touched = [r[0] for r in staged.select(partition_by).distinct().collect()]
    if None in touched:
        raise ValueError(f"rows without {partition_by} cannot be stored")
    if not touched:
        return []
    target = read_or_empty(spark, path, staged.schema).where(F.col(partition_by).isin(touched))
    write_partitions(merge(target.select(*staged.columns), staged), path, [partition_by])
    return sorted(touched)


def write_json(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Small result documents as JSON, one file per partition value; replaces only those."""
    writer = df.repartition(1).write.mode("overwrite")
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.json(path)


def write_dq(rules: DataFrame, path: str, run_date: str) -> None:
    """The DQ document of a day: its five rule rows under ``dt=``."""
    write_json(rules.withColumn("dt", F.lit(str(run_date))), path, ["dt"])


def write_backtest(metrics: DataFrame, path: str, run_date: str) -> None:
    """The backtest document of a day; nothing was matched, nothing is written."""
    document = metrics.withColumns(
        {"run_date": F.lit(str(run_date)), "dt": F.lit(str(run_date))}
    )
    write_json(document, path, ["dt"])


def write_predictions(scored: DataFrame, root: str, source: str, run_date: str) -> None:
    """Capture scored requests as JSON below ``<source>/<day>``, as the backtest reads them."""
    names = ("route_id", "stop_id", "trip_id", "service_date", "predicted_delay_sec",
             "delay_t_minus_15")
    captured = scored.select(
        *[F.col(n) if n in scored.columns else F.lit(None).alias(n) for n in names]
    )
    captured.write.mode("append").json(f"{root}/{source}/{run_date}")


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """A query result with a header line; ``files=1`` for one file of a small result."""
    laid_out = df.repartition(files) if files else df
    laid_out.write.mode("overwrite").option("header", "true").csv(path)

"""What several operators share: row identity, folds, staging, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.session import stage

__all__ = [
    "NO_ID", "connected_components", "fold", "lower_ascii", "own", "rid", "small",
    "spanning_links", "stage", "text_hash",
]

#: Stands for a NULL id where rows are matched; the id itself stays NULL in results.
NO_ID = -(2**63)
#: Tables of ids or single words with at most so many rows are broadcast, larger ones shuffled.
BROADCAST_ROWS = 2_000_000
#: Edges that a task contracts before the first round.
EDGES_PER_TASK = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def own(df: DataFrame, name: str) -> str:
    """A column name for the operator's own use that ``df`` does not have."""
    name = f"__{name}"
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def rid(name: str = "doc_id") -> Column:
    """A row's id for matching, never NULL."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def text_hash(name: str = "text") -> Column:
    """With ``rid``, tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(F.col(name), F.lit("")))


def fold(k: int, name: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo ``k``; a NULL id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % k


def small(df: DataFrame) -> DataFrame:
    """A staged table of ids or words, broadcast if its rows are counted and few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ``translate`` makes a string of every character,
    so it is left to texts that hold others than ASCII."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _roots(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars around the smallest id of what they connect."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = _roots(parent, a), _roots(parent, b)
            parent[max(x, y)] = min(x, y)
    pairs = [(x, r) for x in parent if (r := _roots(parent, x)) != x]
    for k in range(0, len(pairs), 50_000):
        a, b = zip(*pairs[k : k + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _stars(edges: DataFrame) -> bool:
    """Whether every id is the end of one edge at most, or a centre, never both."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("end"), F.lit(0).alias("centre")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    mixed = ends.groupBy("id").agg(F.sum("end").alias("end"), F.max("centre").alias("centre"))
    return mixed.where("end > 1 OR (end > 0 AND centre > 0)").isEmpty()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in ``edges(a, b)``; component is the smallest id reached.

    Tasks first contract bounded shares of the edges to stars. Then alternating large-star
    and small-star steps (Kiveris et al., 2014) follow, until all that is left are stars:
    each is one minimum per node and one join, so a hub's edges are pre-aggregated and its
    join can be split. Every round is written to the shared folder, which keeps the lineage
    short. Loops and repeated edges are harmless.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = stage(down.distinct(), name)
    if not _stars(edges):
        shares = edges.count() // EDGES_PER_TASK + 1
        edges = stage(edges.repartition(shares).mapInArrow(_contract, "a long, b long").distinct(), name)
    while not _stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        large = stage(large, name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))  # a > b in every edge by now
        small = large.join(low, "a").select(
            F.explode(F.array(
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("e")
        ).select("e.*").where("a <> b").distinct()
        edges = stage(small, name)
    ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.union(edges.select("b", "b")).distinct()


def spanning_links(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Links (by places ``i``, ``j`` in ``ids``) as stars that connect the same ids."""
    parent: dict[int, int] = {}
    for a, b in zip(ids[i].tolist(), ids[j].tolist(), strict=True):
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        x, y = _roots(parent, a), _roots(parent, b)
        parent[max(x, y)] = min(x, y)
    return [(x, r) for x in parent if (r := _roots(parent, x)) != x]

"""Hard negatives by threshold joins over partial inverted indexes.

A search asks for the first ``k`` rows of a score window per query. Rows and queries meet in
tiles. A tile indexes its rows by dimension, and leaves out a row's last dimensions where
their norm times the largest query norm over them stays below the threshold. Queries
accumulate partial scores list by list; a pair is dropped once its score so far plus the
product of the norms that remain is below the threshold, and what is left is scored exactly.
Windows that found fewer than ``k`` rows go into the next round with a lower threshold, down
to their own floor.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import rid, stage

#: Rows and queries of a tile, at most about so many.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Dimensions whose lists are accumulated between two prunings.
STRIDE = 8
#: Positives' thresholds by round, as shares of the anchor's product with itself.
POSITIVE_STEPS = (0.6, 0.3, None)
#: Negatives' thresholds by round, as shares of the way from the window's cap to its floor.
NEGATIVE_STEPS = (0.25, 0.6, 1.0)
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
#: Sums of products below this are exact in double precision.
_EXACT = 2.0**53

_FOUND = "win long, row long, score long"


def _left_norms(vectors: np.ndarray) -> np.ndarray:
    """Column j: the norm of what stands from dimension j on (0 at the end)."""
    squares = np.cumsum(vectors[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.c_[squares, np.zeros(len(vectors))])


def indexed_dims(norms: np.ndarray, query_norms: np.ndarray, threshold: float) -> np.ndarray:
    """How many leading dimensions of each row the index holds.

    The others are left out: their norm times the largest query norm over the same
    dimensions is below the threshold, so they alone cannot bring a pair up to it.
    """
    if threshold <= 0:
        return np.full(len(norms), norms.shape[1] - 1)
    open_ = norms * query_norms.max(axis=0) * (1 + 1e-9) >= threshold
    return open_.sum(axis=1)  # norms fall, so the open dimensions lead


def candidates(
    queries: np.ndarray, rows: np.ndarray, thresholds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs whose score may reach the query's threshold.

    Dimensions come in order of their energy. Rows come in order of how many dimensions
    they have in the index, so the list of a dimension is a prefix of the rows.
    """
    n, dims = rows.shape
    order = np.argsort(-(rows**2).sum(axis=0), kind="stable")
    queries, rows = queries[:, order], rows[:, order]
    query_norms, norms = _left_norms(queries), _left_norms(rows)
    held = indexed_dims(norms, query_norms, float(thresholds.min()))
    place = np.argsort(-held, kind="stable")
    held, norms = held[place], norms[place]
    lists = [rows[place[: int(np.searchsorted(-held, -d, "left"))], d] for d in range(dims)]
    score = np.zeros((len(queries), n))
    alive = np.ones((len(queries), n), bool)
    slack = 1e-9 * query_norms[:, :1] * norms[:, 0] + 1e-9
    for start in range(0, dims, STRIDE):
        stop = min(start + STRIDE, dims)
        for d in range(start, stop):
            count = len(lists[d])
            if not count:
                break
            score[:, :count] += queries[:, d, None] * lists[d]
        reached = np.minimum(held, stop)  # a row's first dimension that is not in its score
        left = query_norms[:, reached] * norms[np.arange(n), reached]
        alive &= score + left + slack >= thresholds[:, None]
        if not len(lists[stop - 1]) or not alive.any():
            break
    i, j = np.nonzero(alive)
    return i, place[j]


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of paired integer rows; as Python integers where they are large."""
    if not len(left) or not left.shape[1]:
        return np.zeros(len(left), np.int64)
    bound = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    if bound < _EXACT:
        return np.einsum("ij,ij->i", left.astype(float), right.astype(float)).astype(np.int64)
    return (left.astype(object) * right.astype(object)).sum(axis=1)


def _tile(k: int, same_label: bool):
    """The first ``k`` rows of each window of a tile, by score, id and row."""

    def run(windows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(windows) and len(rows):
            first = windows.drop_duplicates("anchor_row", ignore_index=True)
            queries = np.stack(first["codes"].to_numpy()).astype(np.int64)
            codes = np.stack(rows["codes"].to_numpy()).astype(np.int64)
            least = windows.groupby("anchor_row")["threshold"].min().loc[first["anchor_row"]]
            row, name, label = (rows[c].to_numpy() for c in ("row", "rid", "label"))
            asks = {a: g for a, g in windows.groupby("anchor_row")}
            i, j = candidates(queries.astype(float), codes.astype(float), least.to_numpy(float))
            edges = np.searchsorted(i, np.arange(len(first) + 1))  # i is sorted
            for q, (anchor, own) in enumerate(zip(first["anchor_row"], first["label"], strict=True)):
                at = j[edges[q] : edges[q + 1]]
                at = at[(row[at] != anchor) & ((label[at] == own) == same_label)]
                score = _scores(np.broadcast_to(queries[q], (len(at), queries.shape[1])), codes[at])
                fits = (score <= _HIGHEST) & (score >= _LOWEST)
                at, score = at[fits], score[fits].astype(np.int64)
                ranked = np.lexsort((row[at], name[at], ~score))  # the complement falls as the score rises
                at, score = at[ranked], score[ranked]
                for win, low, high in zip(*(asks[anchor][c] for c in ("win", "threshold", "cap")), strict=True):
                    into = np.flatnonzero((score >= low) & (score <= high))[:k]
                    out += zip([win] * len(into), row[at[into]], score[into], strict=True)
        return pd.DataFrame(out, columns=["win", "row", "score"]).astype("int64")

    return run


def _round(windows: DataFrame, rows: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(win, row, rid, vec_id, score, rank): the first ``k`` rows of each window."""
    group = ["dims", "label"] if same_label else ["dims"]

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy(*group).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    shape = blocks(rows, BLOCK_ROWS, "row_blocks").join(blocks(windows, BLOCK_QUERIES, "query_blocks"), group)
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = windows.join(shape, group).withColumn("query_block", dealt("anchor_row", "query_blocks")).select(
        *group, "query_block", each("row_blocks").alias("row_block"), "win", "anchor_row", "codes",
        "threshold", "cap", *([] if same_label else ["label"]),
    )
    right = rows.join(shape, group).withColumn("row_block", dealt("row", "row_blocks")).select(
        *group, each("query_blocks").alias("query_block"), "row_block", "row", "rid", "codes",
        *([] if same_label else ["label"]),
    )
    key = [*group, "query_block", "row_block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_tile(k, same_label), _FOUND)
    place = F.row_number().over(Window.partitionBy("win").orderBy(F.desc("score"), "rid", "row"))
    named = found.join(rows.select("row", "rid", "vec_id"), "row")
    return named.withColumn("rank", place).where(F.col("rank") <= k)


def first_in_windows(
    windows: DataFrame, rows: DataFrame, thresholds: list[Column], k: int, same_label: bool
) -> DataFrame:
    """(win, row, rid, vec_id, score, rank) of the first ``k`` rows in each window.

    ``windows`` has (win, anchor_row, label, dims, codes, cap) and whatever ``thresholds``
    are made of, one a round, falling; the last is each window's floor. A window that is
    full at a threshold is done, since all rows from there on were found.
    """
    done = None
    for turn, threshold in enumerate(thresholds):
        asked = windows.withColumn("threshold", threshold.cast("long"))
        found = stage(_round(asked, rows, k, same_label), f"negatives-round-{turn}")
        if turn < len(thresholds) - 1:
            full = found.where(F.col("rank") == k).select("win")
            windows = stage(windows.join(full, "win", "left_anti"), "windows-left")
            found = found.join(full, "win", "left_semi")
        done = found if done is None else done.unionByName(found)
        if turn < len(thresholds) - 1 and windows.isEmpty():
            break
    return done


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component ``x`` counts as ``floor(scale * x)``; scores are integer inner products,
    higher first, ties by the smaller id. An anchor's positives are its first ``positives``
    other rows of its label, its negatives per positive the first ``negatives`` rows of other
    labels whose score is between ``low`` and ``high`` percent of the positive's; where
    fewer exist, all of them. A positive score below 0 has no negatives.

    Rows with a NULL label, a NULL vector, or NULL or non-finite components take no part, nor
    do such with components of 2^54 / ``scale`` or more; a score that is no 64-bit integer
    is no match. Vectors of different dimension do not meet; empty ones score 0. Every row
    is a row, also when rows repeat: copies of the anchor are other rows. NULL ids count as
    the smallest and come out as NULL. Other columns are not used. An empty table gives an
    empty table.
    """
    full = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x * scale) < F.lit(2.0**54)))
    rows = (
        vectors.select(
            F.col("vec_id").cast("long"), rid("vec_id").alias("rid"), "label",
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & full)
        .select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "rid", "label", "anchor",
            F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("codes"),
            F.size("embedding").alias("dims"),
        )
    )
    rows = stage(rows, "coded-vectors")
    itself = F.aggregate("codes", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    anchors = stage(rows.where("anchor").select(
        F.col("row").alias("win"), F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"),
        "label", "dims", "codes", F.lit(_HIGHEST).alias("cap"), itself.alias("itself"),
    ), "anchors")
    steps = [F.lit(_LOWEST) if s is None else F.ceil(F.col("itself") * s) for s in POSITIVE_STEPS]
    best = first_in_windows(anchors, rows, steps, positives, same_label=True).select(
        "win", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    score = F.col("positive_score").cast("decimal(38,0)")
    pairs = best.join(anchors.drop("cap", "itself"), "win").where("positive_score >= 0").select(
        F.monotonically_increasing_id().alias("win"), "anchor_row", "anchor_id", "label", "dims", "codes",
        "positive_id", "positive_score",
        F.ceil(score * low / 100).cast("long").alias("floor"),
        F.floor(score * high / 100).cast("long").alias("cap"),
    )
    pairs = stage(pairs, "anchor-positives")
    way = lambda s: F.col("cap") - F.floor((F.col("cap") - F.col("floor")) * s)
    steps = [F.col("floor") if s == 1 else way(s) for s in NEGATIVE_STEPS]
    found = first_in_windows(pairs, rows, steps, negatives, same_label=False)
    return found.join(pairs.select("win", "anchor_id", "positive_id", "positive_score"), "win").select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op13_hard_negative_mining(spark, sf_dir) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; ids divisible by 7 get the next label."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", shifted)
    return mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
negative AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positive p JOIN pair n ON p.anchor_id = n.anchor_id AND NOT n.same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 10
"""

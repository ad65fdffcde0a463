"""Near-duplicate vectors by int8 products with rigorous error bounds.

Unit vectors are quantised to 8 bits with a scale each. A tile of products of quantised
vectors, exact in single precision, bounds every cosine from above; only pairs that may
reach the threshold are computed again from the full vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import NO_ID, connected_components, rid, spanning_links, stage

THRESHOLD = 0.93
#: Vectors in a block, and rows of a block multiplied at a time.
BLOCK, STRIP = 1024, 256
#: Products of 8-bit values are exact in single precision up to so many dimensions at a time.
EXACT_DIMS = 1024


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, length of the quantised vector, length of its error) of unit vectors."""
    scale = np.abs(vectors).max(axis=1) / 127
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.linalg.norm(back, axis=1), np.linalg.norm(vectors - back, axis=1)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.zeros((len(left), len(right)))
    for k in range(0, left.shape[1], EXACT_DIMS):
        part = slice(k, k + EXACT_DIMS)
        out += left[:, part].astype(np.float32) @ right[:, part].astype(np.float32).T
    return out


def close_pairs(
    left: np.ndarray, right: np.ndarray, threshold: float, same: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs with a cosine of at least ``threshold``; i < j if ``same``.

    With x = s q + e for either vector, the cosine differs from s s' (q . q') by at most
    |s q| |e'| + |e| |s' q'| + |e| |e'|.
    """
    norms = [np.linalg.norm(v, axis=1) for v in (left, right)]
    (q, s, a, b), (q2, s2, a2, b2) = (
        quantise(v / n[:, None]) for v, n in zip((left, right), norms, strict=True)
    )
    found_i, found_j = [], []
    for k in range(0, len(left), STRIP):
        part = slice(k, k + STRIP)
        most = _products(q[part], q2) * (s[part, None] * s2)
        most += a[part, None] * b2 + b[part, None] * (a2 + b2)
        i, j = np.nonzero(most >= threshold - 1e-9)
        i += k
        if same:
            i, j = i[i < j], j[i < j]
        for m in range(0, len(i), 50_000):
            x, y = i[m : m + 50_000], j[m : m + 50_000]
            cosine = np.einsum("ij,ij->i", left[x], right[y]) / (norms[0][x] * norms[1][y])
            found_i.append(x[cosine >= threshold])
            found_j.append(y[cosine >= threshold])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_i or none), np.concatenate(found_j or none)


def _compare(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls", ignore_index=True)
        vectors = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
        ids, n, block = (pdf[c].to_numpy() for c in ("cls", "n", "block"))
        one, two = key[-2:]
        if one == two:
            i, j = close_pairs(vectors, vectors, threshold, same=True)
        else:
            x, y = np.flatnonzero(block == one), np.flatnonzero(block == two)
            i, j = close_pairs(vectors[x], vectors[y], threshold)
            i, j = x[i], y[j]
        links = np.bincount(i, n[j], len(ids)) + np.bincount(j, n[i], len(ids))
        rows = [(0, int(ids[h]), int(links[h])) for h in np.flatnonzero(links)]
        rows += [(1, a, b) for a, b in spanning_links(ids, i, j)]
        out = pd.DataFrame(rows, columns=["kind", "a", "b"])
        return out.astype({"kind": "int32", "a": "int64", "b": "int64"})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Vectors of equal, non-NULL labels link when their cosine is at least ``threshold``.
    NULL or zero vectors, and such with NULL or non-finite components, link with nothing,
    nor do vectors of different dimension. Equal vectors of a label are compared once and
    count as linked. ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the smallest id reached, ``kept`` is true where it is the row's own.
    Every row is a vector, also when rows repeat; rows with a NULL id count as the smallest,
    and their component's id is NULL. Other columns are not used.
    """
    data = vectors.select(
        F.col("vec_id").cast("long"), rid("vec_id").alias("rid"), "label",
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    data = stage(data.withColumn("usable", usable), "vectors")
    keys = ["label", "embedding"]
    full = data.where("usable")
    classes = full.groupBy(*keys).agg(F.min("rid").alias("first"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
    group = ["label", "dims"]
    sized = classes.withColumn("dims", F.size("embedding"))
    blocks = sized.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (
        sized.join(blocks, group)
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .select(*group, "cls", "n", "embedding", "block", other.alias("other"))
    )
    one, two = F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    compared = stage(
        tiles.groupBy(*group, one, two).applyInPandas(_compare(threshold), "kind int, a long, b long"),
        "compared-vectors",
    )
    links = compared.where("kind = 0").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("links"))
    reach = connected_components(compared.where("kind = 1"), "vector-links")
    grouped = stage(
        classes.select("cls", "first", "n").join(links, "cls", "left")
        .join(reach.withColumnRenamed("id", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")),
        "vector-groups",
    )
    least = grouped.groupBy("component").agg(F.min("first").alias("least"))
    described = grouped.join(least, "component").select(
        "cls", "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")
    ).join(classes.select("cls", *keys), "cls")
    rows = full.join(described, keys).select("vec_id", "rid", "n_links", "least").union(
        data.where("NOT usable").select("vec_id", "rid", F.lit(0).cast("long"), "rid")
    )
    return rows.select(
        "vec_id", "n_links", F.when(F.col("least") != F.lit(NO_ID), F.col("least")).alias("component_id"),
        (F.col("rid") == F.col("least")).alias("kept"),
    )


def op8_embedding_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e)
    >= 0.93 * sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = least.a LEFT JOIN n ON vec_id = n.a
"""

"""A similarity join of documents on word shingles, with Bayesian pruning.

Texts with the same shingles are one class from the start. MinHash bands bring classes
that may be similar together; classes reached through shared bands form a neighbourhood, and
inside it blocks of classes are compared pair by pair: MinHash values some at a time, and a pair
is dropped once the posterior probability that it reaches the threshold is below the
tolerance. What survives is verified on the whole shingle sets. Tasks return sums and
spanning links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import (
    NO_ID,
    connected_components,
    own,
    rid,
    small,
    spanning_links,
    stage,
    text_hash,
)
from headway.llm.shingles import WORDS_PER_SHINGLE, mix, shingle_set

THRESHOLD = 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8^4)^32 < 5e-8.
BANDS, ROWS = 32, 4
#: MinHash values compared at a time, and the posterior below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-7
#: A block holds about so many shingles and classes at most.
BLOCK_SHINGLES, BLOCK_CLASSES = 1_000_000, 1500

_SIGNED = (
    "doc_id long, rid long, th long, n_shingles int, low long, high long, bands array<long>"
)


#: Multipliers (odd) and offsets of the MinHash functions.
_SCALE, _SHIFT = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32).reshape(2, -1)
_SCALE |= np.uint32(1)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` MinHash values (unsigned 32 bits) of a set of shingle hashes."""
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(x), 1024):
        y = x[k : k + 1024, None] * _SCALE + _SHIFT
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        low = np.minimum(low, y.min(axis=0))
    return low


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        pair = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ np.uint64(len(shingles))).sum(dtype=np.uint64)
    return int(pair[0].view(np.int64)), int(pair[1].view(np.int64))


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, low, high, bands = [], [], [], []
            for text in b["text"]:
                s = shingle_set(text.as_py(), k)
                n.append(len(s))
                x, y = _digest(s) if len(s) else (0, 0)
                low.append(x)
                high.append(y)
                bands.append(_bands(minhash(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["rid"], b["th"], pa.array(n, pa.int32()), pa.array(low, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "rid", "th", "n_shingles", "low", "high", "bands"],
            )

    return run


def _shingle(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), k) for t in b["text"]]
            low, high = zip(*[_digest(s) for s in sets], strict=True) if sets else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["low", "high", "shingles"],
            )

    return run


def _bands(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return h.view(np.int64)


def matches_needed(threshold: float, step: int, total: int, tolerance: float) -> tuple[int, ...]:
    """For each multiple of ``step`` values compared: the fewest matches that keep a pair.

    With a uniform prior the similarity given m matches of n is Beta(m + 1, n - m + 1);
    a pair is kept while P(similarity >= threshold) >= tolerance.
    """
    grid = np.linspace(0, 1, 20_001)[1:-1]
    needed = []
    for n in range(step, total + 1, step):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            density = np.exp(log - log.max())
            if density[grid >= threshold].sum() >= tolerance * density.sum():
                needed.append(m)
                break
    return tuple(needed)


def _survivors(left: np.ndarray, right: np.ndarray, same: bool, needed: tuple[int, ...]):
    """Pairs of rows of two signature tables that no comparison has dropped."""
    count = np.zeros((len(left), len(right)), np.uint8)
    for j in range(STEP):
        count += left[:, j, None] == right[None, :, j]
    alive = count >= needed[0]
    if same:
        alive &= np.arange(len(left))[:, None] < np.arange(len(right))
    i, j = np.nonzero(alive)
    got = count[i, j].astype(np.int32)
    for step, least in enumerate(needed[1:], 1):
        at = slice(step * STEP, (step + 1) * STEP)
        for k in range(0, len(i), 200_000):
            part = slice(k, k + 200_000)
            got[part] += (left[i[part], at] == right[j[part], at]).sum(axis=1, dtype=np.int32)
        keep = got >= least
        i, j, got = i[keep], j[keep], got[keep]
    return i, j


def _verified(left: list, right: list, i: np.ndarray, j: np.ndarray, threshold: float):
    """Those pairs whose sets have at least the threshold's Jaccard similarity, exactly."""
    if not len(i):
        return i, j
    used = np.unique(j)
    every = np.concatenate([right[x] for x in used])
    values, codes = np.unique(every, return_inverse=True)
    sizes = np.array([len(right[x]) for x in used])
    starts = np.r_[0, np.cumsum(sizes)]
    coded = {int(x): codes[starts[k] : starts[k + 1]] for k, x in enumerate(used)}
    mark = np.zeros(len(values), bool)
    keep = np.zeros(len(i), bool)
    edges = np.flatnonzero(np.r_[True, i[1:] != i[:-1], True])  # i is sorted
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        mine = left[i[s]]
        at = np.searchsorted(values, mine)
        at[at == len(values)] = 0
        at = at[values[at] == mine]
        mark[at] = True
        for k in range(s, e):
            other = coded[int(j[k])]
            shared = int(np.count_nonzero(mark[other]))
            keep[k] = shared >= threshold * (len(mine) + len(other) - shared) - 1e-9
        mark[at] = False
    return i[keep], j[keep]


def _compare(threshold: float):
    """All pairs of one block, or of two: partial link counts per class, and spanning links."""

    needed = matches_needed(threshold, STEP, BANDS * ROWS, TOLERANCE)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls", ignore_index=True)
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        signs = np.stack([minhash(s) for s in sets])
        ids, docs, block = (pdf[c].to_numpy() for c in ("cls", "n_docs", "block"))
        if key[1] == key[2]:
            i, j = _survivors(signs, signs, True, needed)
            i, j = _verified(sets, sets, i, j, threshold)
        else:
            x, y = np.flatnonzero(block == key[1]), np.flatnonzero(block == key[2])
            i, j = _survivors(signs[x], signs[y], False, needed)
            i, j = _verified([sets[k] for k in x], [sets[k] for k in y], i, j, threshold)
            i, j = x[i], y[j]
        links = np.bincount(i, docs[j], len(ids)) + np.bincount(j, docs[i], len(ids))
        has = np.flatnonzero(links)
        rows = [(0, int(ids[h]), int(links[h])) for h in has]
        rows += [(1, a, b) for a, b in spanning_links(ids, i, j)]
        out = pd.DataFrame(rows, columns=["kind", "a", "b"])
        return out.astype({"kind": "int32", "a": "int64", "b": "int64"})

    return run


def similar_documents(
    docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS_PER_SHINGLE
) -> DataFrame:
    """One row per document: (doc_id, class_id, copy_of, n_links, kept, rid, th).

    Documents link when their sets of ``words``-word shingles have a Jaccard similarity of
    at least ``threshold``. A text of fewer words, but not none, has one shingle: all its
    words. A NULL text or one without words has none and links with nothing. ``copy_of`` is
    the smallest id with the same shingles, ``class_id`` the smallest id reached over links,
    ``n_links`` how many other documents the document links with, copies included, and
    ``kept`` marks the one row per class that stays: of the smallest id, of the smallest
    text hash. Every row is a document, also when rows repeat. NULL ids count as the
    smallest and come out as NULL. ``rid`` and ``th`` tell rows apart that share an id.
    Other columns are not used. An empty table gives an empty table.
    """
    signed = docs.select(
        F.col("doc_id").cast("long"), rid().alias("rid"), text_hash().alias("th"), "text"
    ).mapInArrow(_sign(words), _SIGNED)
    signed = stage(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    # Classes of equal shingle sets; their keys are fixed by being written.
    full = signed.where("n_shingles > 0")
    classes = full.groupBy("low", "high").agg(
        F.min(F.struct("rid", "th", "row")).alias("first"), F.count("*").alias("n_docs"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
    )
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    each = classes.select("cls", F.posexplode("bands").alias("band", "value"))
    buckets = each.groupBy("band", "value").agg(
        F.min("cls").alias("b"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    near = each.join(buckets, ["band", "value"]).select(F.col("cls").alias("a"), "b")
    reach = connected_components(near, "neighbourhoods")
    # Blocks: as many per neighbourhood as its size asks for.
    sized = reach.join(classes.drop("bands"), reach["id"] == classes["cls"])
    load = sized.groupBy("component").agg(
        F.greatest(
            F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_CLASSES)
        ).cast("int").alias("blocks")
    )
    members = stage(
        sized.join(load, "component").select(
            "component", "cls", "n_docs", "low", "high", "first.rid", "first.th", "blocks",
            F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"),
        ),
        "members",
    )
    # Shingles are made anew, for the few classes that have a neighbour only.
    texts = docs.select(rid().alias("rid"), text_hash().alias("th"), "text").join(
        small(members.select("rid", "th")), ["rid", "th"], "left_semi"
    )
    made = texts.mapInArrow(_shingle(words), "low long, high long, shingles binary")
    made = made.groupBy("low", "high").agg(F.first("shingles").alias("shingles"))
    tiles = members.join(made, ["low", "high"]).select(
        "component", "block", "cls", "n_docs", "shingles",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    compared = tiles.groupBy(
        "component", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")
    ).applyInPandas(_compare(threshold), "kind int, a long, b long")
    compared = stage(compared, "compared")
    links = compared.where("kind = 0").groupBy(F.col("a").alias("cls")).agg(F.sum("b").alias("links"))
    groups = connected_components(compared.where("kind = 1").select("a", "b"), "similar")
    grouped = stage(
        classes.select("low", "high", "cls", "first", "n_docs")
        .join(links, "cls", "left")
        .join(groups.withColumnRenamed("id", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")),
        "grouped",
    )
    leaders = grouped.groupBy("component").agg(F.min("first").alias("leader"))
    described = grouped.join(leaders, "component").select(
        "low", "high", F.col("first.rid").alias("copy_of"), "leader",
        (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )
    known = lambda c: F.when(F.col(c) != F.lit(NO_ID), F.col(c))
    similar = full.join(described, ["low", "high"]).select(
        "doc_id", known("leader.rid").alias("class_id"), known("copy_of").alias("copy_of"),
        "n_links", (F.col("row") == F.col("leader.row")).alias("kept"), "rid", "th",
    )
    alone = signed.where("n_shingles = 0").select(
        "doc_id", "doc_id", "doc_id", F.lit(0).cast("long"), F.lit(True), "rid", "th"
    )
    return similar.union(alone)


def keep_one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``similar_documents`` keeps, all columns as they are."""
    columns = docs.columns
    r, t, n, place = (own(docs, c) for c in ("rid", "th", "kept", "place"))
    # Rows without words may share id and text, and each is kept as often as it stands there.
    once = similar_documents(docs, threshold).where("kept").groupBy(
        F.col("rid").alias(r), F.col("th").alias(t)
    ).agg(F.count("*").alias(n))
    order = F.row_number().over(Window.partitionBy(r, t).orderBy(r))
    return (
        docs.withColumns({r: rid(), t: text_hash()}).join(once, [r, t]).withColumn(place, order)
        .where(F.col(place) <= F.col(n)).select(*[f"`{c}`" for c in columns])
    )


def op7_ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    out = similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.drop("rid", "th")

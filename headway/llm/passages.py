"""Word windows that repeat across documents, found by level-wise doubling.

A repeated window of the full length repeats in all its parts, so the search starts at a
quarter of the length or less, and only windows that repeat at one length are looked at
with twice that length, until the full length is reached or no candidate is left. At the
first length the least of all windows inside each full window stands for it, which every copy
of the full window picks as well. Texts with the same words are one text from the start.

Each level range-partitions its window hashes (128 bits) with document and position, sorts
them and streams the runs of equal hashes. A window that fills many partitions is a chain of
runs, whose ends meet in a table of at most two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import own, rid, small, stage, text_hash
from headway.llm.shingles import hash_spans, mix

LENGTH = 50
#: The first length is the largest halving of the full one that is no longer than this.
FIRST_LENGTH = 13
#: Fixed value: bytes between words, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
#: Windows per range partition.
WINDOWS_PER_TASK = 2_000_000

_BLANK = np.isin(np.arange(256), [ord(c) for c in BLANKS])
_WINDOWS = "h1 long, h2 long, rid long, th long, pos int"
_RUNS = f"kind int, {_WINDOWS}, low long, high long"
_SHARED, _PENDING, _BORDER = 0, 1, 2
_PLACE = np.uint64((1 << 30) - 1)
_LANES = (np.uint64(0), np.uint64(0xA0761D6478BD642F))


def lengths(full: int) -> list[int]:
    """Window lengths by level, each at most twice the one before."""
    out = [full]
    while out[0] > FIRST_LENGTH:
        out.insert(0, (out[0] + 1) // 2)
    return out


def words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of the words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_BLANK[data]
    edge = np.diff(inside)
    return data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, from those of half as many, and so on."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    span, h = 1, hashes
    while span < length:
        step = min(span, length - span)
        h = mix(h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) + h[step:] + np.uint64(step))
        span += step
    return h


def representatives(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places of the least hash of each ``width`` in a row, leftmost of the least ones."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    place = (least & _PLACE).astype(np.int64)
    return place[np.r_[True, place[1:] != place[:-1]]]


def _lanes(text: str | None) -> list[np.ndarray]:
    h = hash_spans(*words(text))
    return [h, mix(h + _LANES[1])]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits that stand for a text's words in order."""
    for b in batches:
        rows = []
        for text in b["text"]:
            lanes = _lanes(text.as_py())
            n = len(lanes[0])
            place = mix(np.arange(1, n + 1, dtype=np.uint64))
            rows.append((n, *(int(mix(h ^ place).sum(dtype=np.uint64).view(np.int64)) for h in lanes)))
        n, d1, d2 = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [b["rid"], b["th"], pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64())],
            names=["rid", "th", "n_words", "d1", "d2"],
        )


def _windows(length: int, starts_of):
    """Windows of ``length`` words at the starts that ``starts_of`` gives for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            given = b["starts"].to_pylist() if "starts" in b.schema.names else [None] * b.num_rows
            for r, t, text, known in zip(b["rid"].to_pylist(), b["th"].to_pylist(), b["text"], given, strict=True):
                one, two = (window_hashes(h, length) for h in _lanes(text.as_py()))
                at = starts_of(one, known)
                yield pa.RecordBatch.from_arrays(
                    [_signed(one[at]), _signed(two[at]), pa.array(np.full(len(at), r)),
                     pa.array(np.full(len(at), t)), pa.array(at.astype(np.int32))],
                    names=["h1", "h2", "rid", "th", "pos"],
                )

    return run


def _extended(size: int, new: int, full: int):
    """Starts of windows of ``new`` words, given those of ``size`` words that repeat.

    Below the full length, a window is extended to the right and to the left, one of which
    lies inside any full window around it; at the full length all windows around it count.
    """
    moves = np.array([0, size - new]) if new < full else np.arange(size - new, 1)

    def starts_of(hashes: np.ndarray, known: list[int]) -> np.ndarray:
        at = np.unique(np.asarray(known)[:, None] + moves)
        return at[(at >= 0) & (at < len(hashes))]

    return starts_of


def _stream_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of windows that several ids hold, and the ends of runs that may go on elsewhere.

    ``low`` is an id that holds the window: a smaller one, or the row's own if it is the
    least. Of a partition's first run, only the rows of its least id wait for what earlier
    partitions hold.
    """
    key = low = high = None  # the open run: its window, least and greatest id
    held: list[list[np.ndarray]] = []  # its rows of the least id
    opening = True

    def batch(kind: int, cols: list[np.ndarray], low, high) -> pa.RecordBatch:
        n = len(cols[0])
        full = lambda x: np.broadcast_to(np.asarray(x, np.int64), n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), *(pa.array(c.astype(np.int64)) for c in cols[:4]),
             pa.array(cols[4].astype(np.int32)), pa.array(full(low)), pa.array(full(high))],
            names=["kind", "h1", "h2", "rid", "th", "pos", "low", "high"],
        )

    def feed(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nonlocal high, held
        high = int(cols[2][-1])
        own = int(np.searchsorted(cols[2], low, "right"))
        if own:
            held.append([c[:own] for c in cols])
        if low != high:
            if not opening:
                for x in held:
                    yield batch(_SHARED, x, low, high)
                held = []
            if own < len(cols[2]):
                yield batch(_SHARED, [c[own:] for c in cols], low, high)

    def close(at_end: bool) -> Iterator[pa.RecordBatch]:
        nonlocal opening
        if opening or at_end:
            for x in held:
                yield batch(_PENDING, x, low, high)
            edge = [np.array([x]) for x in (*key, 0, 0, 0)]
            yield batch(_BORDER, edge, low, high)
        opening = False

    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(b.schema.get_field_index(c))) for c in ("h1", "h2", "rid", "th", "pos")]
        h1, h2, r = cols[:3]
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        ends = np.r_[starts[1:], len(h1)]
        for i in dict.fromkeys((0, len(starts) - 1)):
            s, e = starts[i], ends[i]
            here = (int(h1[s]), int(h2[s]))
            if here != key:
                if key is not None:
                    yield from close(at_end=False)
                key, low, held = here, int(r[s]), []
            yield from feed([c[s:e] for c in cols])
        if len(starts) > 2:
            inner = slice(1, -1)
            shared = r[starts[inner]] != r[ends[inner] - 1]
            n = (ends - starts)[inner]
            rows = np.r_[np.zeros(ends[0], bool), np.repeat(shared, n), np.zeros(ends[-1] - starts[-1], bool)]
            yield batch(
                _SHARED, [c[rows] for c in cols], np.repeat(r[starts[inner]][shared], n[shared]),
                np.repeat(r[ends[inner] - 1][shared], n[shared]),
            )
    if key is not None:
        yield from close(at_end=True)


def held_by_several(windows: DataFrame, name: str) -> DataFrame:
    """(rid, th, pos, low): windows that several ids hold.

    ``low`` is below ``rid`` if and only if a smaller id holds the window.
    """
    windows = stage(windows, name)
    spark = windows.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), windows.count() // WINDOWS_PER_TASK + 1
    )
    order = ["h1", "h2", "rid", "th", "pos"]
    ranged = windows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    runs = stage(ranged.mapInArrow(_stream_runs, _RUNS), f"{name}-runs")
    chained = (
        runs.where(f"kind = {_BORDER}").groupBy("h1", "h2")
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").drop("high")
    )
    pending = runs.where(f"kind = {_PENDING}").drop("low", "high").join(chained, ["h1", "h2"])
    cols = ["rid", "th", "pos", "low"]
    return runs.where(f"kind = {_SHARED}").select(*cols).union(pending.select(*cols))


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rid, th, text, and what else ``ids`` has) of the rows that ``ids`` names."""
    return docs.select(rid().alias("rid"), text_hash().alias("th"), "text").join(small(ids), ["rid", "th"])


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(rid, th, pos, low) of each window of ``length`` words that several documents hold.

    ``pos`` is the window's first word; ``low`` is a smaller id that holds it, or the row's
    own where there is none. Fully equal rows repeat their windows.
    """
    sizes = lengths(length)
    width = length - sizes[0] + 1
    source = docs.select(rid().alias("rid"), text_hash().alias("th"), "text")
    first = lambda hashes, _: representatives(hashes, width)
    windows = source.mapInArrow(_windows(sizes[0], first), _WINDOWS)
    found = held_by_several(windows, f"windows-{sizes[0]}")
    for size, new in zip(sizes, sizes[1:], strict=False):
        left = found.groupBy("rid", "th").agg(F.collect_set("pos").alias("starts"))
        left = stage(left, f"candidates-{size}")
        if left.isEmpty():
            return found.limit(0)
        windows = _texts(docs, left).mapInArrow(_windows(new, _extended(size, new, length)), _WINDOWS)
        found = held_by_several(windows, f"windows-{new}")
    return found


def passage_losses(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(rid, th, whole, starts): what each document that loses words loses.

    ``starts`` are the first words of its windows that a document with a smaller id holds;
    ``whole`` says that such a document has all its words.
    """
    texts = docs.select(rid().alias("rid"), text_hash().alias("th"), "text").mapInArrow(
        _digest, "rid long, th long, n_words long, d1 long, d2 long"
    )
    texts = stage(texts.where(F.col("n_words") >= length), "long-texts")
    least = texts.groupBy("d1", "d2").agg(F.min("rid").alias("rid"))
    key = ["d1", "d2", "rid"]
    judged = stage(texts.join(least, key, "left_semi").select("rid", "th").distinct(), "judged")
    copies = texts.join(least, key, "left_anti").select(
        "rid", "th", F.lit(True).alias("whole"), F.lit(None).cast("array<int>").alias("starts")
    ).distinct()
    found = repeated_windows(_named(docs, judged), length).where("low < rid")
    parts = found.groupBy("rid", "th").agg(F.collect_set("pos").alias("starts"))
    return copies.union(parts.select("rid", "th", F.lit(False), "starts"))


def _named(docs: DataFrame, ids: DataFrame) -> DataFrame:
    keys = [rid().alias("__rid"), text_hash().alias("__th"), F.col("doc_id"), F.col("text")]
    named = small(ids).select(F.col("rid").alias("__rid"), F.col("th").alias("__th"))
    return docs.select(*keys).join(named, ["__rid", "__th"], "left_semi").select("doc_id", "text")


def _cut(length: int, whole: str, starts: str, n_words: str, n_removed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, counts, gone = [], [], []
            for text, everything, at in zip(b["text"], b[whole].to_pylist(), b[starts].to_pylist(), strict=True):
                text = text.as_py()
                data, s, e = words(text)
                counts.append(len(s))
                if not everything and at is None:
                    kept.append(text)
                    gone.append(0)
                    continue
                stay = np.zeros(len(s), bool)
                if not everything:
                    cover = np.zeros(len(s) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.asarray(at) + length, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                raw = data.tobytes()
                joined = b" ".join([raw[x:y] for x, y in zip(s[stay].tolist(), e[stay].tolist(), strict=True)])
                kept.append(joined.decode("utf-8", "surrogatepass"))
                gone.append(int(len(s) - stay.sum()))
            names = [c for c in b.schema.names if c not in ("text", whole, starts)]
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in names], pa.array(kept, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(gone, pa.int64())],
                names=[*names, "text", n_words, n_removed],
            )

    return run


def drop_repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` without repeated passages, plus ``own(docs, "n_words")`` and "n_removed".

    Words are what blanks ``[\\x20\\x09-\\x0D]`` separate. A word goes if a window of
    ``length`` words around it also stands in a document with a smaller id; windows are
    judged on the input. A document that loses words comes out as its other words joined by
    blanks, all others as they are. NULL and blank texts have no words, texts shorter than
    ``length`` no window. Rows of equal id, or both without one, take nothing from each
    other; a NULL id counts as the smallest. Every row is a document, also when rows
    repeat. All other columns pass through. An empty table gives an empty table.
    """
    columns = docs.columns
    r, t, whole, starts, n_words, n_removed = (
        own(docs, c) for c in ("rid", "th", "whole", "starts", "n_words", "n_removed")
    )
    losses = stage(passage_losses(docs.select("doc_id", "text"), length), "passage-losses").select(
        F.col("rid").alias(r), F.col("th").alias(t), F.col("whole").alias(whole), F.col("starts").alias(starts)
    )
    joined = docs.withColumns({r: rid(), t: text_hash()}).join(losses, [r, t], "left").drop(r, t)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema
             if f.name not in ("text", whole, starts)]
    out = joined.mapInArrow(
        _cut(length, whole, starts, n_words, n_removed),
        ", ".join([*kinds, "`text` string", f"`{n_words}` long", f"`{n_removed}` long"]),
    )
    return out.select(*[f"`{c}`" for c in columns], n_words, n_removed)


def op11_substring_dedup(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = F.regexp_replace(F.btrim(F.coalesce("text", F.lit("")), F.lit(BLANKS)), r"[\x20\x09-\x0D]+", " ")
    return drop_repeated_passages(docs).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


SQL = r"""
WITH word AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, pos, md5(array_to_string(w[pos : pos + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM word WHERE len(w) >= 50)),
bad AS (
  SELECT doc_id, pos FROM win JOIN (SELECT h, min(doc_id) AS low FROM win GROUP BY h) USING (h)
  WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM bad, range(50) AS r(k)),
each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM word),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE g.pos IS NOT NULL) AS n_removed,
    coalesce(string_agg(x, ' ' ORDER BY e.pos) FILTER (WHERE g.pos IS NULL), '') AS kept
  FROM each e LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM word LEFT JOIN kept USING (doc_id)
"""

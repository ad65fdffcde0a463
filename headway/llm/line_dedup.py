"""Lines that many documents share, dropped by per-document keep bitmaps.

Line keys are hashed (128 bits), range-partitioned by hash, document and position, and
sorted; each task streams its runs of equal hashes. A key that fills many partitions is a
chain of partial runs whose counts meet in one small table of at most two rows per
partition. The outcome is one compressed bitmap per document that loses a line.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import lower_ascii, own, rid, stage, text_hash

MIN_DOCS = 10
#: Fixed value: what the key strips at both ends, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
#: Line keys per range partition.
KEYS_PER_TASK = 2_000_000
#: Documents that a task takes apart and hands back at once.
ROWS_AT_ONCE = 1_000

_RUNS = (
    "kind int, h1 long, h2 long, rid long, th long, pos int, n_lines int, "
    "n_docs long, last_rid long, last_th long, part int"
)
_DROP, _PENDING, _BORDER = 0, 1, 2
_ROW = ("h1", "h2", "rid", "th", "pos", "n_lines")


def line_keys(docs: DataFrame) -> DataFrame:
    """(h1, h2, rid, th, pos, n_lines): one row per line whose key is not empty."""
    lines = docs.select(
        rid().alias("rid"),
        text_hash().alias("th"),
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
    )
    each = lines.select(
        "rid", "th", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line")
    )
    key = lower_ascii(F.btrim("line", F.lit(BLANKS)))
    return each.select("rid", "th", "pos", "n_lines", key.alias("key")).where("key <> ''").select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("line"), "key").alias("h2"),
        "rid", "th", "pos", "n_lines",
    )


def _stream_runs(min_docs: int):
    """Rows of keys with enough documents, and partial counts where a run may go on."""

    def batch(kind, cols, n_docs=0, last=(0, 0), part=0):
        n = len(cols[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32))]
            + [pa.array(c.astype(np.int32 if k > 3 else np.int64)) for k, c in enumerate(cols)]
            + [pa.array(np.full(n, x, np.int64)) for x in (n_docs, *last)]
            + [pa.array(np.full(n, part, np.int32))],
            names=["kind", *_ROW, "n_docs", "last_rid", "last_th", "part"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        key = first = last = None  # the open run: its key, first and last document
        docs, held, opening = 0, [], True

        def close(at_end: bool):
            nonlocal opening
            if opening or at_end:
                if docs < min_docs:
                    for cols in held:
                        yield batch(_PENDING, cols)
                edge = [np.array([x]) for x in (*key, *first, 0, 0)]
                yield batch(_BORDER, edge, docs, last, part)
            opening = False

        for b in batches:
            if not b.num_rows:
                continue
            cols = [np.asarray(b.column(b.schema.get_field_index(c))) for c in _ROW]
            h1, h2, r, t = cols[:4]
            new_key = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            new_doc = new_key | np.r_[True, (r[1:] != r[:-1]) | (t[1:] != t[:-1])]
            starts = np.flatnonzero(new_key)
            ends = np.r_[starts[1:], len(h1)]
            counts = np.add.reduceat(new_doc.astype(np.int64), starts)
            keep = np.zeros(len(h1), bool)
            inner = counts >= min_docs
            inner[[0, -1]] = False
            for s, e in zip(starts[inner], ends[inner], strict=True):
                keep[s:e] = True
            for i in dict.fromkeys((0, len(starts) - 1)):
                s, e = starts[i], ends[i]
                here, n = (int(h1[s]), int(h2[s])), int(counts[i])
                if key is not None and here != key:
                    yield from close(at_end=False)
                    key = None
                if i and i == len(starts) - 1 and keep.any():
                    yield batch(_DROP, [c[keep] for c in cols])
                    keep[:] = False
                doc = (int(r[s]), int(t[s]))
                if key is None:
                    key, first, docs, held = here, doc, 0, []
                elif doc == last:
                    n -= 1
                docs += n
                last = (int(r[e - 1]), int(t[e - 1]))
                held.append([c[s:e] for c in cols])
                if docs >= min_docs:
                    for x in held:
                        yield batch(_DROP, x)
                    held = []
                if i == 0 and len(starts) > 1:
                    yield from close(at_end=False)
                    key = None
        if key is not None:
            yield from close(at_end=True)

    return run


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(rid, th, n_lines, pos) of every line whose key at least ``min_docs`` documents hold."""
    spark = docs.sparkSession
    keys = stage(line_keys(docs), "line-keys")
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), keys.count() // KEYS_PER_TASK + 1
    )
    order = ["h1", "h2", "rid", "th", "pos"]
    ranged = keys.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    runs = stage(ranged.mapInArrow(_stream_runs(min_docs), _RUNS), "line-runs")
    chain = Window.partitionBy("h1", "h2").orderBy("part", "rid", "th")
    same = (F.lag("last_rid").over(chain) == F.col("rid")) & (
        F.lag("last_th").over(chain) == F.col("th")
    )
    shared = (
        runs.where(f"kind = {_BORDER}")
        .select("h1", "h2", (F.col("n_docs") - F.coalesce(same, F.lit(False)).cast("int")).alias("n"))
        .groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
        .select("h1", "h2")
    )
    cols = ["rid", "th", "n_lines", "pos"]
    pending = runs.where(f"kind = {_PENDING}").join(shared, ["h1", "h2"]).select(*cols)
    return runs.where(f"kind = {_DROP}").select(*cols).union(pending)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, n_dropped = [], []
        for n, gone in zip(b["n_lines"].to_pylist(), b["gone"].to_pylist(), strict=True):
            bits = np.ones(n, np.uint8)
            bits[gone] = 0
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
            n_dropped.append(len(gone))
        yield pa.RecordBatch.from_arrays(
            [b["rid"], b["th"], pa.array(n_dropped, pa.int64()), pa.array(keep, pa.binary())],
            names=["rid", "th", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(rid, th, n_dropped, keep): a bitmap per document that loses lines.

    ``keep`` is the zlib-compressed bit per line, first line first, 1 for kept. Documents
    without an entry keep all their lines. ``rid`` is the id (NULL: ``common.NO_ID``) and
    ``th`` the text's hash, so rows that share an id are told apart; fully equal rows are
    one document and share an entry.
    """
    gone = dropped_lines(docs, min_docs).groupBy("rid", "th").agg(
        F.first("n_lines").alias("n_lines"), F.collect_set("pos").alias("gone")
    )
    return gone.mapInArrow(_pack, "rid long, th long, n_dropped long, keep binary")


def _unpack(keep_name: str, n_lines_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE)):
            kept, n_lines = [], []
            for text, keep in zip(b["text"].to_pylist(), b[keep_name].to_pylist(), strict=True):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if keep is None:
                    kept.append(text)
                    continue
                bits = np.frombuffer(zlib.decompress(keep), np.uint8)
                places = np.flatnonzero(np.unpackbits(bits, count=len(lines)))
                kept.append("\n".join([lines[i] for i in places]))
            names = [c for c in b.schema.names if c not in ("text", keep_name)]
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in names], pa.array(kept, pa.string()), pa.array(n_lines, pa.int64())],
                names=[*names, "text", n_lines_name],
            )

    return run


def drop_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with shared lines gone from ``text``, plus ``own(docs, "n_lines")``, "n_dropped".

    Lines are what ``\\n`` separates; a NULL or empty text is one empty line and stays as it
    is. A line's key is the line stripped of blanks at both ends, A-Z lower-cased; empty keys
    are never dropped. Keys found in at least ``min_docs`` documents lose all their lines
    everywhere. Fully equal rows are one document for the count and come out equal. All other
    columns pass through under their own names. An empty table gives an empty table.
    """
    columns = docs.columns
    r, t, lines, dropped, keep = (
        own(docs, c) for c in ("rid", "th", "n_lines", "n_dropped", "keep")
    )
    found = keep_bitmaps(docs, min_docs).select(
        F.col("rid").alias(r), F.col("th").alias(t),
        F.col("n_dropped").alias(dropped), F.col("keep").alias(keep),
    )
    joined = (
        docs.withColumns({r: rid(), t: text_hash()})
        .join(found, [r, t], "left")
        .withColumn(dropped, F.coalesce(dropped, F.lit(0).cast("long")))
        .drop(r, t)
    )
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema
             if f.name not in ("text", keep)]
    out = joined.mapInArrow(
        _unpack(keep, lines), ", ".join([*kinds, "`text` string", f"`{lines}` long"])
    )
    return out.select(*[f"`{c}`" for c in columns], lines, dropped)


def op2_line_dedup(spark, sf_dir) -> DataFrame:
    out = drop_shared_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(text, 256).alias("kept_sha256"),
    )


SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
shared AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE s.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE s.key IS NULL), ''))
    AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key GROUP BY doc_id
"""

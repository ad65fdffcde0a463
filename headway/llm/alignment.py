"""Two tokenizers' tokens of the same text, aligned by the byte offsets where both end.

Cumulative ends go into dictionaries from end to index; the intersection of their keys, sorted,
slices both id lists into groups, and each slice is expanded into links of overlapping
tokens. Neither tokenizer joins what stands before a blank with what follows it, so a text
is aligned stretch by stretch, and a stretch met before is looked up.

Documents are gathered into blocks, which hold each stretch once. Blocks send their pair
counts to a corpus-wide sum and get back the totals of their own pairs only.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256
from functools import lru_cache
from itertools import chain, compress, pairwise

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stage

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Stretches in a block, of one document at least.
BLOCK_STRETCHES = 1_000_000
#: Stretches and characters of them that a task remembers before it starts afresh.
KNOWN, KNOWN_CHARS = 400_000, 20_000_000
#: Characters of the texts whose new stretches are learned together.
PARCEL_CHARS = 2_000_000
#: How byte-level vocabularies spell bytes: printable ones as themselves, others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [c for c in range(256) if c not in _PRINTABLE]
_SPELLED = {chr(c): c for c in _PRINTABLE} | {chr(0x100 + k): c for k, c in enumerate(_OTHERS)}
_SPELLING = {c: 0x100 + k for k, c in enumerate(_OTHERS)}
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKS = f"block long, {_DOC}, codes binary, cuts binary, places binary, pairs array<long>, counts array<long>"


def align(
    ids_a: list[int], ends_a: list[int], ids_b: list[int], ends_b: list[int]
) -> tuple[list[tuple[list[int], list[int]]], np.ndarray]:
    """Groups of ids between common ends, and the pairs of ids whose tokens overlap.

    Ends grow strictly. A pair is ``left id << 32 | right id``. Inside a slice no two ends
    meet, so a link begins wherever a token of either side does: the link that ends at ``e``
    is of the tokens that hold the byte before ``e``.
    """
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    groups, i, j = [], 0, 0
    for end in common:
        x, y = at_a[end], at_b[end]
        groups.append((ids_a[i:x], ids_b[j:y]))
        i, j = x, y
    ends = np.array(sorted(at_a.keys() | at_b.keys()), np.int64)
    left = np.array(ids_a, np.int64)[np.searchsorted(np.array(ends_a, np.int64), ends)]
    right = np.array(ids_b, np.int64)[np.searchsorted(np.array(ends_b, np.int64), ends)]
    return groups, (left << 32) | right


class Aligner:
    """Both tokenizers, and what is known of the stretches met so far.

    A stretch begins with a blank or line feed that a visible character follows. It is kept
    under its text in a spelling where every line feed has a blank before it, without the
    first blank, so that splitting a text at blanks gives its stretches.
    """

    def __init__(self, left: str, right: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark fills the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(left)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=right)
        spelled = [self.a.id_to_token(k) for k in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(_SPELLED[c] for c in s) if set(s) <= _SPELLED.keys() else s.encode() for s in spelled]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes_b = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        self.length_a, self.length_b = (
            np.array([len(x) for x in known], np.int64) for known in (self.bytes_a, self.bytes_b)
        )
        self.endings = {}
        for c in ".,":
            a, b = self.a.encode(c).ids, [k for k, p in enumerate(pieces) if p == c]
            if len(a) == len(b) == 1 and not any(x.isalpha() and y == c for p in pieces for x, y in pairwise(p)):
                self.endings[c] = (f"{a[0]}|{b[0]}", array("q", [(a[0] << 32) | b[0]]).tobytes(), (1, 1, 1, 1))
        self.clear()

    def clear(self) -> None:
        self.starting: dict[str, int] = {}  # stretches of one part, which any document may hold
        self.other: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.pairs: list[bytes] = []
        self.counts = [array("q") for _ in _COUNTS]

    @property
    def full(self) -> bool:
        return len(self.groups) > KNOWN or self.chars > KNOWN_CHARS

    def _put(self, into: dict[str, int], keys: list[str], groups: list[str], pairs: list[bytes], counts) -> None:
        """``counts``: one sequence of numbers for each of ``_COUNTS``."""
        into.update(zip(keys, range(len(self.groups), len(self.groups) + len(keys)), strict=True))
        self.chars += sum(map(len, keys))
        self.groups += groups
        self.pairs += pairs
        for column, xs in zip(self.counts, counts, strict=True):
            column.extend(xs)

    def _learn(self, keys: list[str], into: dict[str, int]) -> None:
        """Stretches are aligned a few at a time, as if they followed each other in one text."""
        for k in range(0, len(keys), 2000):
            part = keys[k : k + 2000]
            texts = [f" {x}".replace(" \n", "\n") for x in part]
            coded = self._left_ids(part, texts)
            # The second tokenizer puts a blank before every text; before a line feed it is a piece alone.
            pieces = self.b.encode([t.removeprefix(" ") for t in texts], num_threads=1)
            for n, text in enumerate(texts):
                if text == " ":  # no text, for which it has not even its blank
                    pieces[n] = self.b.encode("\n")[:1]
                if text[0] == "\n":
                    pieces[n] = pieces[n][1:]
            data = [t.encode("utf-8", "surrogatepass") for t in texts]
            self._align_part(into, part, data, coded, pieces)

    def _align_part(self, into: dict[str, int], keys: list, data: list, coded: list, pieces: list) -> None:
        size = np.fromiter(map(len, data), np.int64, len(data))
        sides, spelled = [], b"".join(data)
        for ids, known, lengths in ((coded, self.bytes_a, self.length_a), (pieces, self.bytes_b, self.length_b)):
            flat = list(chain.from_iterable(ids))
            upto = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            ends = np.cumsum(lengths[flat])
            same = b"".join(map(known.__getitem__, flat)) == spelled and len(flat) > 0
            if not same or not np.array_equal(np.r_[0, ends][upto], np.cumsum(size)):
                break
            sides.append((flat, upto, ends))
        if len(sides) < 2:  # some are not what their tokens spell
            right = [
                b"".join(map(self.bytes_a.__getitem__, a)) == d == b"".join(map(self.bytes_b.__getitem__, b))
                for a, b, d in zip(coded, pieces, data, strict=True)
            ]
            wrong = [x for x, ok in zip(keys, right, strict=True) if not ok]
            self._put(into, wrong, [""] * len(wrong), [b""] * len(wrong), [[-1] * len(wrong)] * len(_COUNTS))
            if any(right):
                self._align_part(into, *[list(compress(x, right)) for x in (keys, data, coded, pieces)])
            return
        (a, upto_a, ends_a), (b, upto_b, ends_b) = sides
        found, links = align(a, ends_a.tolist(), b, ends_b.tolist())
        groups = [
            f"{x[0]}|{y[0]}" if len(x) == len(y) == 1 else f"{','.join(map(str, x))}|{','.join(map(str, y))}"
            for x, y in found
        ]
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        ends_groups = np.cumsum(np.fromiter((len(x) for x, _ in found), np.int64, len(found)))
        upto_groups = np.searchsorted(ends_groups, upto_a) + 1
        n_groups = np.diff(upto_groups, prepend=0)
        n_links = n_a + n_b - n_groups
        stored, upto = links.tobytes(), (8 * np.cumsum(n_links)).tolist()
        self._put(
            into, keys,
            [";".join(groups[i:j]) for i, j in pairwise([0, *upto_groups.tolist()])],
            [stored[i:j] for i, j in pairwise([0, *upto])],
            [x.tolist() for x in (n_a, n_b, n_groups, n_links)],
        )

    def _left_ids(self, keys: list[str], texts: list[str]) -> list[list[int]]:
        """Letters after a blank are one unit for the model, spelled in its byte alphabet."""
        ids = [
            [t.id for t in self.a.model.tokenize(text.encode().decode("latin-1").translate(_SPELLING))]
            if key.isalpha() else None for key, text in zip(keys, texts, strict=True)
        ]
        rest = [k for k, x in enumerate(ids) if x is None]
        coded = self.a.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)
        for k, one in zip(rest, coded, strict=True):
            ids[k] = one.ids
        return ids

    def _learn_parts(self, parts: set[str]) -> None:
        """A full stop or comma after a letter is a token of its own for both tokenizers."""
        ended = {p for p in parts if p[-1] in self.endings and p[-2:-1].isalpha()}
        stems = {p[:-1] for p in ended} | ({"\n."[1:], ","} if ended else set())
        self._learn(sorted(((parts - ended) | stems).difference(self.starting)), self.starting)
        at = {p: self.starting[p[:-1]] for p in ended}
        unlike = [p for p, stem in at.items() if self.counts[0][stem] < 0]
        self._learn(unlike, self.starting)
        for c, (groups, pairs, counts) in self.endings.items():
            keys = [p for p, stem in at.items() if p[-1] == c and self.counts[0][stem] >= 0]
            stems = [at[p] for p in keys]
            self._put(
                self.starting, keys,
                [f"{self.groups[k]};{groups}" for k in stems],
                [self.pairs[k] + pairs for k in stems],
                [[column[k] + n for k in stems] for column, n in zip(self.counts, counts, strict=True)],
            )

    def stretches(self, text: str) -> np.ndarray:
        return self.stretches_of([text])[0]

    def stretches_of(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of each text's stretches, one after the other; what is new is learned for all texts at once."""
        split = [t.replace("\n", " \n").split(" ") for t in texts]
        new = set(chain.from_iterable(split)).difference(self.starting)
        never = {p for p in new if not _may_start(p)}
        self._learn_parts(new - never)
        return [self._numbers(parts, never) for parts in split]

    def _numbers(self, parts: list[str], never: set[str]) -> np.ndarray:
        if never.isdisjoint(parts):
            return np.fromiter(map(self.starting.__getitem__, parts), np.int32, len(parts))
        keys, last = [], None
        for p in parts:
            if keys and (p in never or (last == "" and not p.startswith("\n"))):
                keys[-1].append(p)
            else:
                keys.append([p])
            last = p
        joined = [" ".join(k) for k in keys]
        odd = {k for k, x in zip(joined, keys, strict=True) if len(x) > 1 or x[0] in never}
        self._learn(sorted(odd.difference(self.other)), self.other)
        return np.array([self.other[k] if k in odd else self.starting[k] for k in joined], np.int32)


@lru_cache(maxsize=1)
def _aligner(left: str, right: str) -> Aligner:
    """One for all tasks of a worker process, which keep what is known."""
    return Aligner(left, right)


def _may_start(part: str) -> bool:
    """Whether a stretch may begin here: a visible character follows the blank or line feed."""
    first = part[1:2] if part.startswith("\n") else part[:1]
    return bool(first) and not first.isspace()


def _parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, str]]]:
    """(doc_id, text) by parcels of ``PARCEL_CHARS``, the last text of a parcel whole."""
    some, chars = [], 0
    for b in batches:
        for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
            some.append((doc_id, text.as_py()))
            chars += len(some[-1][1] or "")
            if chars >= PARCEL_CHARS:
                yield some
                some, chars = [], 0
    if some:
        yield some


def _blocks(left: str, right: str):
    """A row per document, and per block one that holds its stretches' links and pair counts."""

    def flush(block: int, aligner: Aligner, docs: list) -> pa.RecordBatch:
        per = [np.frombuffer(c, np.int64) for c in aligner.counts]
        every = np.concatenate([d[1] for d in docs]) if docs else np.zeros(0, np.int32)
        times = np.bincount(every, minlength=len(aligner.groups))
        used = np.flatnonzero((times > 0) & (per[0] >= 0)) if len(every) else np.zeros(0, np.int64)
        local = np.full(len(aligner.groups) + 1, -1, np.int32)
        local[used] = np.arange(len(used))
        links = np.frombuffer(b"".join([aligner.pairs[k] for k in used.tolist()]), np.int64)
        n_links = per[3][used] if len(used) else np.zeros(0, np.int64)
        rows, weight = [], np.zeros(len(used), np.int64)
        for doc_id, at in docs:
            if not len(at) or (per[0][at] < 0).any():
                rows.append((block, doc_id, 0, 0, 0, 0, "", b""))
                continue
            groups = ";".join(map(aligner.groups.__getitem__, at.tolist()))
            sums = [int(c[at].sum()) for c in per]
            codes = local[at]
            weight += np.bincount(codes, minlength=len(used))
            rows.append((block, doc_id, *sums, sha256(groups.encode()).hexdigest(), codes.tobytes()))
        pairs, places = np.unique(links, return_inverse=True)
        counts = np.bincount(places, np.repeat(weight, n_links), len(pairs)).astype(np.int64)
        cuts = np.r_[0, np.cumsum(n_links)].astype(np.int64)
        schema = pa.schema([
            ("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
            ("groups_sha256", pa.string()), ("codes", pa.binary()), ("cuts", pa.binary()), ("places", pa.binary()),
            ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ])
        rows = [(*r, None, None, None, None) for r in rows]
        shared = (cuts.tobytes(), places.astype(np.int32).tobytes(), pairs, counts)
        rows.append((block, None, None, None, None, None, None, None, *shared))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligner(left, right)
        block, docs, held = TaskContext.get().partitionId() << 32, [], 0
        for some in _parcels(batches):
            found = iter(aligner.stretches_of([text for _, text in some if text]))
            for doc_id, text in some:
                docs.append((doc_id, next(found) if text else np.zeros(0, np.int32)))
                held += len(docs[-1][1])
            if held >= BLOCK_STRETCHES or aligner.full:
                yield flush(block, aligner, docs)
                block, docs, held = block + 1, [], 0
                if aligner.full:
                    aligner.clear()
        if docs:
            yield flush(block, aligner, docs)

    return run


def _describe(rows: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block, with the corpus-wide counts of their links."""
    shared = rows[rows["pairs"].notna()].iloc[0]
    docs = rows[rows["pairs"].isna()]
    totals = totals.sort_values("pair")  # the block's pairs, in the block's own order
    places = np.frombuffer(shared["places"], np.int32)
    cuts = np.frombuffer(shared["cuts"], np.int64)
    per = []
    for column in (totals["total"].to_numpy(np.int64), totals["best"].to_numpy(np.int64)):
        sums = np.r_[0, np.cumsum(column[places])]
        per.append(sums[cuts[1:]] - sums[cuts[:-1]])
    out = docs[["doc_id", *_COUNTS, "groups_sha256"]].copy()
    codes = [np.frombuffer(c, np.int32) for c in docs["codes"]]
    out["n_best"] = [int(per[1][c].sum()) for c in codes]
    out["count_sum"] = [int(per[0][c].sum()) for c in codes]
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def align_documents(docs: DataFrame, left: str | None = None, right: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) per document.

    ``left`` is a byte-level vocabulary and reads a blank and the text, ``right`` a piece
    vocabulary, which adds that blank; special tokens are neither added nor recognised.
    Groups are what lies between byte offsets where tokens of both end, links the pairs of
    tokens that overlap. A pair of ids counts how many links of all documents hold it;
    ``count_sum`` adds these counts over a document's links and ``n_best`` counts the links
    whose pair has the highest count of its ``right`` id, ties included. ``groups_sha256``
    is the digest of ``a1,a2|b1;a3|b2,b3``, decimal ids in order.

    NULL and empty texts, and texts whose tokens do not spell them, have no tokens: zeros and
    ''. Every row is a document, also when rows repeat or ids are NULL. Other columns are
    not used. An empty table gives an empty table.
    """
    left, right = left or public_tokenizers.path(LEFT), right or public_tokenizers.path(RIGHT)
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_blocks(left, right), _BLOCKS)
    rows = stage(rows, "aligned-blocks")
    pairs = rows.where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip("pairs", "counts")).alias("e")
    ).select(F.col("block").alias("in_block"), F.col("e.pairs").alias("pair"), F.col("e.counts").alias("n"))
    totals = stage(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    right_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("right_id")
    # At most one row per id of the vocabulary, so the broadcast is bounded.
    highest = totals.groupBy(right_id).agg(F.max("total").alias("highest"))
    totals = totals.select("*", right_id).join(F.broadcast(highest), "right_id").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("int").alias("best")
    )
    back = pairs.select("in_block", "pair").join(totals, "pair")
    return rows.groupBy("block").cogroup(back.groupBy("in_block")).applyInPandas(
        _describe, f"{_DOC}, n_best long, count_sum long"
    )


def op12_cross_tokenizer_alignment(spark, sf_dir) -> DataFrame:
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

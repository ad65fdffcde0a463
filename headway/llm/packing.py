"""Documents as token sequences of fixed room, packed by bin completion.

Pieces of equal length are interchangeable, so the packing is solved on the histogram of
lengths (at most ``capacity`` counts, whatever the corpus) as fillings with multiplicities.
Each piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import logging
import os
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import stage
from headway.session import bound_batches

log = logging.getLogger(__name__)

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 0
#: Bytes that the words and ids remembered by a worker may take, and what each takes besides its own.
CACHED_BYTES, ENTRY_BYTES = 64 << 20, 150
#: Byte tables: line end to blank, and A-Z to a-z besides. Other white space stays in words.
_BLANKED = bytes(32 if c == 10 else c for c in range(256))
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c for c in _BLANKED)
#: How byte-level vocabularies spell bytes: printable ones as themselves, others from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLED = {c: 0x100 + k for k, c in enumerate(c for c in range(256) if c not in _PLAIN)}
#: Steps of the search before the best packing so far is taken.
SEARCH_STEPS = 2_000_000
#: Steps that a test for dominance and a packing begun count for.
DOMINANCE_STEPS, BRANCH_STEPS = 10, 100
#: So many fillings of a bin are tried in order of their waste, the others as they are met.
SORTED_FILLINGS = 30
#: Pieces of one length ranked together.
RANK_ROWS = 50_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Token ids of a text, word by word.

    No token spans white space and none depends on what stands before it, so a word always
    has the same ids; only words not met before are encoded. The vocabulary has no capitals,
    and a full stop or comma after a letter is a token of its own, so words that differ in
    no more are encoded once. What is remembered takes ``CACHED_BYTES`` between texts, however
    long the words are.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark fills the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _learn(self, words: list[bytes]) -> None:
        mixed = []
        for word in words:
            text = word.decode("utf-8")
            if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
                # Letters alone are one unit for the model, spelled in its byte alphabet.
                spelled = text if text.isascii() else word.decode("latin-1").translate(_SPELLED)
                ids = array("I", [t.id for t in self.tokenizer.model.tokenize(spelled)])
                self.known[word] = ids.tobytes()
            else:
                mixed.append(text)
        for k in range(0, len(mixed), 5000):
            part = mixed[k : k + 5000]
            coded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update(
                (w.encode("utf-8"), array("I", e.ids).tobytes())
                for w, e in zip(part, coded, strict=True)
            )

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        data = text.encode("utf-8")
        # The vocabulary's special tokens are written in small letters and match as such only.
        words = data.translate(_BLANKED if b"<|" in data else _FOLDED).split(b" ")
        known = self.known
        new = set(words).difference(known)
        if new:
            before = len(known)
            ended = {w for w in new if w[-1:] in (b".", b",") and w[-2:-1].isalpha()}
            stems = (new - ended) | {w[:-1] for w in ended} | {b".", b","}
            self._learn([w for w in stems if w not in known])
            known.update((w, known[w[:-1]] + known[w[-1:]]) for w in ended)
            self.held += sum(_room(*x) for x in islice(reversed(known.items()), len(known) - before))
        ids = b"".join(map(known.__getitem__, words))
        if self.held > CACHED_BYTES:
            self._forget()
        return ids

    def _forget(self) -> None:
        """The words met first, among them the common ones, stay in half the room."""
        while self.held > CACHED_BYTES // 2:
            self.held -= _room(*self.known.popitem())


def _room(word: bytes, ids: bytes) -> int:
    return len(word) + len(ids) + ENTRY_BYTES


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The one of this worker process, which its tasks use in turn."""
    return WordIds(path)


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each document's ids and its end id.

    A NULL or empty text has the end id alone. Documents longer than ``capacity`` are cut
    into full pieces; only the last piece may be shorter.
    """
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                ids = words.encode(text.as_py() or "") + end
                for k in range(0, len(ids), step):
                    part = ids[k : k + step]
                    rows.append((doc_id, k // step, k // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins (Martello and Toth's L2)."""
    number = np.cumsum(counts[: capacity + 1])
    tokens = np.cumsum((counts * np.arange(len(counts)))[: capacity + 1])
    k, half = np.arange(capacity // 2 + 1), capacity // 2
    alone = number[-1] - number[capacity - k]
    halves = number[capacity - k] - number[half]
    room = halves * capacity - (tokens[capacity - k] - tokens[half])
    small = tokens[half] - np.r_[0, tokens][k]
    return int(max(-(-tokens[-1] // capacity), (alone + halves + np.maximum(0, -(-(small - room) // capacity))).max()))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the histogram: fillings (descending lengths) and multiplicities.

    Open bins of equal content are one entry, so a length placed into many equal bins takes
    one step.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms = np.zeros(capacity + 1, bool)

    def put(filling: tuple[int, ...], room: int, n: int) -> None:
        at = by_room.setdefault(room, {})
        at[filling] = at.get(filling, 0) + n
        rooms[room] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                filling, n = by_room[room].popitem()
                if not by_room[room]:
                    rooms[room] = False
            else:
                room, filling, n = capacity, (), left
            k = min(room // length if not filling else 1, left)
            m = min(n, left // k)
            if n > m and filling:
                put(filling, room, n - m)
            put(filling + (length,) * k, room - k * length, m)
            left -= m * k
    return [(f, n) for at in by_room.values() for f, n in at.items()]


def dominated(filling: tuple[int, ...], waste: int, counts: np.ndarray) -> bool:
    """Whether a longer piece that is left would take the place of one or two of the filling's.

    What it frees fits wherever it stood itself, so some best packing does without the filling.
    """
    held = Counter(filling)
    pairs = {(x, y) for k, x in enumerate(filling) for y in filling[k + 1 :]}
    for length, least in [(x, x + 1) for x in held] + [(x + y, x + y) for x, y in pairs]:
        for y in (np.flatnonzero(counts[least : length + waste + 1]) + least).tolist():
            if int(counts[y]) > held[y]:
                return True
    return False


def fillings(counts: np.ndarray, room: int, allowed: int, steps: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Undominated fillings of ``room`` as (waste, lengths), longest pieces first.

    A branch ends when all that is left for it could not bring its waste down to ``allowed``.
    Each visit takes one from ``steps``; at zero the fillings end.
    """
    lengths = np.flatnonzero(counts)[::-1].tolist()
    lengths = [x for x in lengths if 0 < x <= room]
    after = np.cumsum([int(counts[x]) * x for x in lengths[::-1]])[::-1].tolist() + [0]

    def visit(at: int, room: int, chosen: tuple[int, ...]) -> Iterator[tuple[int, tuple[int, ...]]]:
        steps[0] -= 1
        while at < len(lengths) and lengths[at] > room:
            at += 1
        if at == len(lengths):
            if room <= allowed:
                steps[0] -= DOMINANCE_STEPS
                if not dominated(chosen, room, counts):
                    yield room, chosen
            return
        for k in range(at, len(lengths)):
            if room - after[k] > allowed or steps[0] <= 0:
                return
            length = lengths[k]
            for n in range(min(int(counts[length]), room // length), 0, -1):
                yield from visit(k + 1, room - n * length, chosen + (length,) * n)
        # with nothing more: dominated, since a piece left fits

    return visit(0, room, ())


def complete_bins(
    counts: np.ndarray, capacity: int = CAPACITY, steps: int = SEARCH_STEPS
) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Pack a histogram of lengths: (fillings with multiplicities, lower bound).

    Best-fit decreasing is the first incumbent. Then the longest piece left is completed by
    each undominated filling of the rest of its bin, depth first, tried as often as the
    counts allow before it is tried once. A branch is given up when its waste, or the lower
    bound of what is left, cannot beat the incumbent, and when the same pieces were left
    before with no more bins used. The packing is a best one unless ``steps`` (visits within
    fillings, and packings begun) run out first; then it is the best one found, and the
    lower bound tells how far off it can be.
    """
    counts = np.asarray(counts, np.int64)
    bound = lower_bound(counts, capacity)
    incumbent = best_fit(counts, capacity)
    best = sum(n for _, n in incumbent)
    total = int((counts * np.arange(len(counts))).sum())
    budget, met = [steps], {}
    chosen: list[tuple[tuple[int, ...], int]] = []

    def options(left: np.ndarray, bins: int, waste: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
        top = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[top] -= 1
        allowed = (best - 1) * capacity - total - waste
        found = fillings(rest, capacity - top, allowed, budget)
        near = sorted(islice(found, SORTED_FILLINGS), key=lambda x: x[0])
        for lost, others in chain(near, found):
            filling = (top, *others)
            most = min(int(left[x]) // n for x, n in Counter(filling).items())
            yield filling, most, lost
            if most > 1:
                yield filling, 1, lost

    branches = []  # (what is left, bins and waste so far, options not yet tried)
    if best > bound:
        branches.append((counts.copy(), 0, 0, options(counts, 0, 0)))
    while branches and best > bound and budget[0] > 0:
        left, bins, waste, untried = branches[-1]
        filling, n, lost = next(untried, ((), 0, 0))
        del chosen[len(branches) - 1 :]
        if not n:
            branches.pop()
            continue
        budget[0] -= BRANCH_STEPS
        after, used, spilt = left.copy(), bins + n, waste + n * lost
        for x, k in Counter(filling).items():
            after[x] -= n * k
        chosen.append((filling, n))
        if not after.any():
            if used < best:
                incumbent, best = list(chosen), used
            continue
        if total + spilt > (best - 1) * capacity or used + lower_bound(after, capacity) >= best:
            continue
        state = blake2b(after.tobytes(), digest_size=16).digest()
        if met.get(state, used + 1) <= used:
            continue
        met[state] = used
        branches.append((after, used, spilt, options(after, used, spilt)))
    return incumbent, bound


def _places(plan: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Runs of ranks: the pieces of a length from ``rank`` on fill sequences from ``seq`` on."""
    rows, taken, seq = [], {}, 0
    for filling, m in plan:
        offset = 0
        for length in dict.fromkeys(filling):
            k = filling.count(length)
            rank = taken.get(length, 0)
            rows.append((length, rank, seq, k, offset))
            taken[length] = rank + m * k
            offset += k * length
        seq += m
    return pd.DataFrame(rows, columns=["length", "rank", "seq", "k", "offset"]).astype("int64")


def pack_sequences(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """Each document's pieces with their place: ``sequence_id`` and ``offset``.

    Returns (doc_id, piece, start, length, ids_crc32, sequence_id, offset); offsets of a
    sequence are gapless from 0. A row of ``docs`` is a document, also when rows repeat or
    ids are NULL. Other columns are not used. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    path = path or public_tokenizers.path(VOCABULARY)
    pieces = stage(cut_pieces(docs, path, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    plan, bound = complete_bins(counts, capacity)
    if (used := sum(n for _, n in plan)) > bound:
        log.warning("packed into %d sequences; the lower bound is %d", used, bound)
    places = _places(plan)
    # Ranks: within slices of a length, after the counts of the slices before.
    slices = max(64, int(counts.max()) // RANK_ROWS + 1)
    sliced = pieces.withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slices)).cast("int")
    )
    before = sliced.groupBy("length", "slice").agg(F.count("*").alias("n")).select(
        "length", "slice",
        (F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).alias("before"),
    )
    within = F.row_number().over(
        Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    )
    ranked = sliced.withColumn("rank", within).join(before, ["length", "slice"]).select(
        *pieces.columns, (F.col("before") + F.col("rank") - 1).alias("rank")
    )
    keys = (places["length"].to_numpy() << 44) + places["rank"].to_numpy()
    order = np.argsort(keys)
    keys = keys[order]
    rank0, seq0, k0, offset0 = (
        places[c].to_numpy()[order] for c in ("rank", "seq", "k", "offset")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = np.asarray(b["length"]), np.asarray(b["rank"])
            run = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            j = rank - rank0[run]
            where = [pa.array(seq0[run] + j // k0[run]), pa.array(offset0[run] + j % k0[run] * length)]
            yield pa.RecordBatch.from_arrays(
                [b[c] for c in b.schema.names if c != "rank"] + where,
                names=[c for c in b.schema.names if c != "rank"] + ["sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, f"{_PIECES}, sequence_id long, offset long")


def op5_best_fit_packing(spark, sf_dir) -> DataFrame:
    return pack_sequences(spark.read.parquet(f"{sf_dir}/documents.parquet"))

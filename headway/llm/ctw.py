"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each made at a node of the tree of preceding bytes. Every
node mixes its own Krichevsky-Trofimov estimate with that of the deeper context, weighted by
how well either would have coded the training text, which follows from counts alone. So the
model is a table of byte n-gram counts, gathered from all training documents, plus one
bottom-up pass over contexts.

Documents are read in blocks of bounded size. Each block sends its distinct n-grams and words
to the tasks that own them, one packed list per owner, and gets their values back in the
same order; the model as a whole is never sent to any task. There are as many owners as keep
what one of them holds bounded, and no key is hot: a block names it once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fold, stage
from headway.llm.shingles import hash_spans, mix

FOLDS, HELD_OUT = 7, 2
#: Preceding bytes that may decide the next one.
DEPTH = 5
#: The tree below each context of so many bytes is one task's: at most 256 ** 3 n-grams.
STEM = DEPTH - 2
#: Stands before a text and after it; no byte of UTF-8 has this value.
EDGE = 255
#: Bytes of text in a block, unless one document is longer.
BLOCK_BYTES = 8_000_000
#: Places handled at a time; codes up to this size are ranked by a table, others by sorting.
PART, DENSE = 500_000, 16_000_000
#: Keys that one owner holds, about.
OWNED = 3_000_000

_TEXT, _GRAM, _WORD = 0, 1, 2
_FEATURES = "block long, kind int, owner int, n long, payload binary"
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)
#: A-Z to a-z.
_LOWERED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The key of the token that ends every document; word keys are hashes.
END_KEY = int(mix(np.array([EDGE], np.uint64)).view(np.int64)[0])


def byte_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, place, starts): the n-grams that end at each coded byte.

    ``keys`` are the block's distinct n-grams in order, nearest context byte first and the
    byte itself last; ``place`` has one entry per byte and per end; ``starts`` is where each
    text begins in it.
    """
    pad = bytes([EDGE])
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"".join([pad * DEPTH + t + pad for t in texts]), np.uint8)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    coded = np.ones(len(data), bool)
    for k in range(DEPTH):
        coded[starts + DEPTH * np.arange(len(texts)) + k] = False
    symbols = np.unique(data)
    code = np.zeros(256, np.uint8)
    code[symbols] = np.arange(len(symbols))
    code, many = code[data], len(symbols)
    keys, place = np.zeros(1, np.int64), np.zeros(len(data), np.int32)
    # Places before a text go along, with whatever numbers, and are left out in the end.
    parts = [(k, min(k + PART, len(data))) for k in range(DEPTH, len(data), PART)]
    for back in (*range(1, DEPTH + 1), 0):
        size = len(keys) * many

        def codes(start: int, stop: int, place=place, back=back, size=size) -> np.ndarray:
            kind = np.int32 if size < 1 << 31 else np.int64
            return place[start:stop].astype(kind) * kind(many) + code[start - back : stop - back]

        if size <= DENSE:
            there = np.zeros(size, bool)
            for start, stop in parts:
                there[codes(start, stop)[coded[start:stop]]] = True
            unique = np.flatnonzero(there)
            rank = np.cumsum(there, dtype=np.int32)
            rank -= 1
            np.maximum(rank, 0, out=rank)
            for start, stop in parts:
                place[start:stop] = rank[codes(start, stop)]
            del there, rank
        else:
            unique = np.unique(np.concatenate(
                [np.unique(codes(start, stop)[coded[start:stop]]) for start, stop in parts]
            ))
            for start, stop in parts:
                found = np.searchsorted(unique, codes(start, stop))
                place[start:stop] = np.minimum(found, len(unique) - 1)
        keys = (keys[unique // many] << 8) | symbols[unique % many].astype(np.int64)
    return keys, place[coded], starts


def word_keys(data: bytes) -> np.ndarray:
    """Keys of the words ``[^\\x20\\x09-\\x0D]+`` of a lower-cased text, as signed hashes."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.diff(inside)
    return hash_spans(b, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)).view(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return pickle.dumps((len(raw), pa.compress(raw, codec="zstd", asbytes=True)))


def _unpack(packed: bytes) -> tuple:
    size, data = pickle.loads(packed)
    return pickle.loads(pa.decompress(data, size, codec="zstd", asbytes=True))


def _owners(kind: int, keys: np.ndarray, many: int) -> np.ndarray:
    """Who owns each key: n-grams of one stem have one owner."""
    by = keys >> (8 * (1 + DEPTH - STEM)) if kind == _GRAM else keys
    return (mix(by.view(np.uint64)) % np.uint64(many)).astype(np.int32)


def _dealt(kind: int, keys: np.ndarray, many: int) -> Iterator[tuple[int, np.ndarray]]:
    """(owner, places in ``keys`` of what it owns), in the order of the keys."""
    owners = _owners(kind, keys, many)
    order = np.argsort(owners, kind="stable")
    edges = np.searchsorted(owners[order], np.arange(many + 1))
    for owner in range(many):
        if edges[owner] < edges[owner + 1]:
            yield owner, order[edges[owner] : edges[owner + 1]]


def _block_features(
    block: int, ids: list, held: list, texts: list[bytes], many: int
) -> Iterator[pa.RecordBatch]:
    learned = ~np.array(held)

    def rows(kind: int, found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        owner, n, payload = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * len(found)), pa.array([kind] * len(found), pa.int32()),
             pa.array(owner, pa.int32()), pa.array(n, pa.int64()), pa.array(payload, pa.binary())],
            names=["block", "kind", "owner", "n", "payload"],
        )

    def dealt(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        n = n.astype(np.uint32)
        return rows(kind, [
            (owner, len(at), _pack(keys[at], n[at])) for owner, at in _dealt(kind, keys, many)
        ])

    for kind, of in ((_GRAM, byte_grams), (_WORD, block_words)):
        keys, place, starts = of(texts)
        weight = np.repeat(learned, np.diff(np.r_[starts, len(place)]))
        n = np.bincount(place[weight], minlength=len(keys))
        del place, weight
        yield dealt(kind, keys, n)
    yield rows(_TEXT, [(0, len(ids), _pack(ids, held, texts))])


def block_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, place, starts) of a block's words, each text's end included."""
    each = [np.append(word_keys(t), END_KEY) for t in texts]
    keys, place = np.unique(np.concatenate(each), return_inverse=True)
    return keys, place, np.r_[0, np.cumsum([len(w) for w in each])[:-1]]


def _gather(many: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        ids, held, texts, size = [], [], [], 0
        for b in batches:
            known = zip(b["doc_id"].to_pylist(), b["held"].to_pylist(), b["text"], strict=True)
            for doc_id, out, text in known:
                data = (text.as_py() or "").encode("utf-8").translate(_LOWERED)
                if size and size + len(data) > BLOCK_BYTES:
                    yield from _block_features(block, ids, held, texts, many)
                    block, ids, held, texts, size = block + 1, [], [], [], 0
                ids.append(doc_id)
                held.append(out)
                texts.append(data)
                size += len(data) + 1
        if ids:
            yield from _block_features(block, ids, held, texts, many)

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, eight places further on."""
    y = x + 8
    shift = np.log(x)
    for k in range(1, 8):
        shift = shift + np.log(x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the Krichevsky-Trofimov estimator gives such counts in any order."""
    half = _log_gamma(np.array([0.5]))[0]
    return (
        _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - 2 * half - _log_gamma(zeros + ones + 1.0)
    )


def _weighted(kt: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Log of the even mixture of a node's own estimate and its children's product."""
    return np.logaddexp(kt, children) - np.log(2)


def _trees(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The contexts below whole stems, of which ``grams`` has all n-grams, in order.

    Returns per n-gram the probabilities of its eight decisions as mixed so far, and per node
    of the stems' own contexts: stem, decision node, log weighted probability, and counts.
    """
    n = n.astype(np.float64)
    x = grams & 255
    shift = np.arange(8)
    node = (1 << shift) | (x[:, None] >> (8 - shift))
    bit = (x[:, None] >> (7 - shift)) & 1
    mixed = weighted = below = None
    for depth in range(DEPTH, STEM - 1, -1):  # deepest first
        context = grams >> (8 * (1 + DEPTH - depth))
        place = np.cumsum(np.r_[0, context[1:] != context[:-1]])  # they are in order
        unique, inverse = np.unique((place[:, None] * 256 + node).ravel(), return_inverse=True)
        zeros, ones = (
            np.bincount(inverse, (n[:, None] * (bit == v)).ravel(), len(unique)) for v in (0, 1)
        )
        kt = log_kt(zeros, ones)
        inverse = inverse.reshape(bit.shape)
        own = (np.where(bit, ones[inverse], zeros[inverse]) + 0.5) / (zeros + ones + 1)[inverse]
        if mixed is None:
            mixed, weighted = own, kt
        else:
            # Each deeper node has one parent: the same decision, one context byte less.
            parent = np.zeros(len(weighted), np.int64)
            parent[below.ravel()] = inverse.ravel()
            weighted = _weighted(kt, np.bincount(parent, weighted, len(kt)))
            share = np.exp(kt - np.log(2) - weighted)[inverse]
            mixed = share * own + (1 - share) * mixed
        below = inverse
    stems = np.zeros(len(zeros), np.int64)
    stems[below.ravel()] = np.repeat(grams >> (8 * (1 + DEPTH - STEM)), 8)
    return mixed, (stems, unique & 255, weighted, zeros, ones)


def _merged(payloads) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several packed lists, in order, and their summed counts."""
    keys, counts = zip(*[_unpack(p) for p in payloads], strict=True)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts.astype(np.int64), first)


def _spans(keys: np.ndarray, limit: int = 200_000) -> Iterator[slice]:
    """Slices of about so many n-grams that keep stems whole."""
    stems, start = keys >> (8 * (1 + DEPTH - STEM)), 0
    while start < len(keys):
        at = min(start + limit, len(keys)) - 1
        stop = int(np.searchsorted(stems, stems[at], "right"))
        yield slice(start, stop)
        start = stop


def _count_owned(key: tuple, table: pa.Table) -> pa.Table:
    """Of one owner's words: how many training tokens, and how many different ones."""
    _, n = _merged(table["payload"].to_pylist())
    return pa.table({"tokens": [int(n.sum())], "words": [int((n > 0).sum())]})


def _plant(key: tuple, table: pa.Table) -> pa.Table:
    """Nodes of the own contexts of an owner's stems."""
    keys, n = _merged(table["payload"].to_pylist())
    found = [_trees(keys[part], n[part])[1] for part in _spans(keys)]
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    return pa.table(dict(zip(("context", "node", "weighted", "zeros", "ones"), columns, strict=True)))


def _upper(nodes: DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per depth above the stems, deepest first: sorted node keys, weights, estimates of a one.

    A node's key is its context (nearest byte first) and decision node. These contexts are
    shorter than a stem, so their number is bounded by the alphabet, not by the corpus.
    """
    tables = []
    for _ in range(STEM):
        parents = nodes.groupBy(F.shiftright("context", 8).alias("context"), "node").agg(
            *[F.sum(c).alias(c) for c in ("weighted", "zeros", "ones")]
        )
        table = parents.toPandas()
        zeros, ones, below = (table[c].to_numpy(np.float64) for c in ("zeros", "ones", "weighted"))
        kt = log_kt(zeros, ones)
        weighted = _weighted(kt, below)
        keys = table["context"].to_numpy() * 256 + table["node"].to_numpy()
        order = np.argsort(keys)
        share, one = np.exp(kt - np.log(2) - weighted), (ones + 0.5) / (zeros + ones + 1)
        tables.append((keys[order], share[order], one[order]))
        nodes = parents.sparkSession.createDataFrame(table.assign(weighted=weighted), parents.schema)
    return tables


def code_lengths(keys: np.ndarray, n: np.ndarray, tables: list) -> np.ndarray:
    """log10 probability of each n-gram's last byte after its context.

    ``keys`` are in order and have all n-grams of their stems; one with a count of 0 is
    priced as unseen.
    """
    shift, out = np.arange(8), []
    for part in _spans(keys):
        key = keys[part]
        p = _trees(key, n[part])[0]
        x = (key & 255)[:, None]
        node, bit = (1 << shift) | (x >> (8 - shift)), (x >> (7 - shift)) & 1
        for back, (known, share, one) in enumerate(tables, 1):
            wanted = (key >> (8 * (1 + DEPTH - STEM + back)))[:, None] * 256 + node
            at = np.searchsorted(known, wanted)
            own = np.where(bit, one[at], 1 - one[at])
            p = share[at] * own + (1 - share[at]) * p
        out.append(np.log10(p).sum(axis=1))
    return np.concatenate(out)


def _answer(tables):
    """Per block and owner: the values of the keys that the block sent, in its order."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        payloads = table["payload"].to_pylist()
        keys, n = _merged(payloads)
        values = code_lengths(keys, n, tables.value) if key[0].as_py() == _GRAM else n
        answers = [_pack(values[np.searchsorted(keys, _unpack(p)[0])]) for p in payloads]
        return pa.table([table["block"], table["kind"], table["owner"], pa.array(answers, pa.binary())],
                        names=["block", "kind", "owner", "payload"])

    return run


def _score_blocks(train_tokens: int, distinct: int, many: int):
    total = np.log10(train_tokens + distinct + 1)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ids, held, texts = next(_unpack(r["payload"]) for r in rows if r["kind"] == _TEXT)
        sent = {(r["kind"], r["owner"]): r["payload"] for r in rows}

        def values(kind: int, keys: np.ndarray) -> np.ndarray:
            out = np.zeros(len(keys))
            for owner, at in _dealt(kind, keys, many):
                out[at] = _unpack(sent[kind, owner])[0]
            return out

        keys, place, starts = byte_grams(texts)
        score = np.add.reduceat(values(_GRAM, keys)[place], starts)
        del place
        keys, place, starts = block_words(texts)
        counts = values(_WORD, keys)
        base = np.add.reduceat((np.log10(counts + 1) - total)[place], starts)
        known = np.add.reduceat((counts > 0).astype(np.int64)[place], starts)
        n = np.diff(np.r_[starts, len(place)])
        columns = (ids, held, n, known, np.full(len(ids), train_tokens), base, score)
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = [f.split()[0] for f in _SCORES.split(", ")]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: id, fold, token counts, word-count baseline and model score.

    ``score`` is the model's log10 probability of the lower-cased text (A-Z) and its end, in
    bytes; ``base_score`` the add-one unigram's of its words and their end. Both learn from the
    documents outside the held-out fold only. A NULL or empty text has the end alone; a
    NULL id counts as the text '' for its fold. Every row is a document, also when rows
    repeat. Without training text all counts are 0. Other columns are not used. An empty
    table gives an empty table. Words are told apart by 64-bit hashes.
    """
    asked = docs.select(F.col("doc_id").cast("long"), (fold(FOLDS) == HELD_OUT).alias("held"), "text")
    # A byte of text sends less than one key in ten to an owner.
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // (10 * OWNED) + 1)
    features = stage(asked.mapInArrow(_gather(many), _FEATURES), "lm-features", by=("kind",))
    owned = lambda k: features.where(F.col("kind") == k).groupBy("owner")
    train, distinct = owned(_WORD).applyInArrow(_count_owned, "tokens long, words long").agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))
    ).first()
    nodes = owned(_GRAM).applyInArrow(
        _plant, "context long, node long, weighted double, zeros double, ones double"
    )
    tables = docs.sparkSession.sparkContext.broadcast(_upper(stage(nodes, "lm-nodes")))
    texts = features.where(F.col("kind") == _TEXT).select("block", "kind", "owner", "payload")
    answers = features.where(F.col("kind") != _TEXT).groupBy("kind", "owner").applyInArrow(
        _answer(tables), "block long, kind int, owner int, payload binary"
    )
    return (
        texts.union(answers.select("block", "kind", "owner", "payload")).groupBy("block")
        .applyInArrow(_score_blocks(train, distinct, many), _SCORES)
    )


def op9_lm_scoring(spark, sf_dir) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

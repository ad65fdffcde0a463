"""Toxicity from class-conditional Kneser-Ney models over the characters of words.

Each class has its own counts of the longest character n-grams; both back off to the same
continuation counts of shorter ones, so an expression that training hardly holds is judged
alike by either. A word's evidence is its log-likelihood ratio. A document is scored by the
ratio of its length-normalised log-likelihoods, over the whole text and over its strongest
words, which a long text would dilute.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fold, own, stage
from headway.llm.shingles import FOLDED, mix
from headway.session import bound_batches

ORDER, DISCOUNT = 8, 0.75
#: Characters that the uniform distribution below all orders is spread over.
ALPHABET = 300
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
#: The classifier is fitted on about so many labelled documents of a class at most, by hash of
#: the id. This bounds the model, which every task holds.
MAX_PER_CLASS = 2_500
#: Used where the calibration rows lack a class: weights of the features, and a constant.
PLAIN = (0.5, 1.0, 0.0, -6.0)
CACHED_WORDS = 300_000
#: Documents that a task scores and hands back at once, and distinct words judged at once.
ROWS_AT_ONCE, WORDS_AT_ONCE = 256, 4_000
#: Buckets whose starts are looked up at once.
SLOTS_AT_ONCE = 1 << 16
FEATURES = ("strongest", "three", "per_char")
_START, _END = "\x02", "\x03"


def words(text: str | None) -> list[bytes]:
    """Runs of letters and digits, A-Z lower-cased, other scripts' characters included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split(b" ")


def labelled(docs: DataFrame, labels: DataFrame, limit: int = MAX_PER_CLASS) -> DataFrame:
    """(part, toxic, weight, text) of the labelled documents outside the held-out fold.

    A document with several labels is toxic if one of them says so; labels that are NULL are
    none. ``part`` is the fold. Of a class with more than ``limit`` documents a sample by hash
    of the id is taken, and ``weight`` is how many documents each stands for.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic")
    )
    known = known.withColumn("part", fold(FOLDS)).where(F.col("part") != HELD_OUT)
    n = dict(known.groupBy("toxic").count().collect())  # two rows
    weight = [max(1.0, n.get(c, 0) / limit) for c in (0, 1)]
    weight = F.when(F.col("toxic") == 1, weight[1]).otherwise(weight[0])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    known = known.withColumn("weight", weight).where(place * F.col("weight") < 1)
    # The sample is bounded, so its ids may go to every task.
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(
        "part", "toxic", "weight", F.coalesce("text", F.lit("")).alias("text")
    )


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counter(), Counter()

    def flush():
        found = list((counts[0].keys() | counts[1].keys()) - {b""})
        n = [pa.array([c[w] for w in found], pa.int64()) for c in counts]
        counts[0].clear()
        counts[1].clear()
        texts = pa.array([w.decode("utf-8", "replace") for w in found], pa.string())
        return pa.RecordBatch.from_arrays([texts, *n], names=["word", "n0", "n1"])

    for b in batches:
        for text, toxic in zip(b["text"], b["toxic"].to_pylist(), strict=True):
            counts[toxic].update(words(text.as_py()))
        if len(counts[0]) + len(counts[1]) > CACHED_WORDS:
            yield flush()
    yield flush()


def grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n0, n1): the longest n-grams with their counts in ordinary and toxic text."""
    counted = rows.mapInArrow(_count_words, "word string, n0 long, n1 long")
    counted = counted.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    padded = F.concat(F.lit(_START * (order - 1)), "word", F.lit(_END))
    at = F.explode(F.sequence(F.lit(1), F.length("word") + 1))
    each = counted.select(padded.alias("padded"), "n0", "n1", at.alias("at"))
    return each.select(F.substring("padded", F.col("at"), F.lit(order)).alias("gram"), "n0", "n1").groupBy(
        "gram"
    ).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _chain(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each place, n = 0 to ``order``."""
    codes = codes.astype(np.uint64)
    keys = [np.zeros(len(codes), np.uint64)]
    for n in range(order):
        back = np.zeros(len(codes), np.uint64)
        back[n:] = codes[: len(codes) - n] + np.uint64(1)
        keys.append(mix(keys[-1] * np.uint64(3) + back + np.uint64(n << 32)))
    return keys


def _keys(codes: np.ndarray) -> np.ndarray:
    """Keys of the n-grams that the rows of ``codes`` are; as in ``_chain``."""
    keys = np.zeros(len(codes), np.uint64)
    for n in range(codes.shape[1]):
        back = codes[:, -1 - n].astype(np.uint64) + np.uint64(1)
        keys = mix(keys * np.uint64(3) + back + np.uint64(n << 32))
    return keys


class _Table:
    """Values by key, where keys are evenly spread: a bucket by the upper bits, then a few steps."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys = keys[order]
        self.values = [v[order].astype(np.float32) for v in values]
        self.starts = None

    def arrays(self) -> tuple:
        return self.keys, self.values

    @classmethod
    def of(cls, arrays: tuple) -> _Table:
        table = cls.__new__(cls)
        (table.keys, table.values), table.starts = arrays, None
        return table

    def _index(self) -> None:
        bits = max(1, len(self.keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.full((1 << bits) + 1, len(self.keys), np.int32)
        for k in range(0, 1 << bits, SLOTS_AT_ONCE):
            first = np.arange(k, min(k + SLOTS_AT_ONCE, 1 << bits), dtype=np.uint64) << self.shift
            self.starts[k : k + len(first)] = np.searchsorted(self.keys, first)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is missing."""
        if self.starts is None:
            self._index()
        slot = (keys >> self.shift).astype(np.int64)
        at, stop = self.starts[slot], self.starts[slot + 1]
        found = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero(at < stop)
        while len(left):
            place = at[left]
            same = self.keys[place] == keys[left]
            found[left[same]] = place[same]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return found

    def get(self, keys: np.ndarray) -> list[np.ndarray]:
        """Values by key, 0 where it is missing."""
        at = self.find(keys)
        return [np.where(at >= 0, v[at], 0).astype(np.float64) if len(v) else np.zeros(len(at)) for v in self.values]


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    unique, where = np.unique(keys, return_inverse=True)
    return (unique, *(np.bincount(where, v, len(unique)) for v in values))


class KneserNey:
    """Both class models, built from the counts of the longest n-grams."""

    def __init__(self, codes: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> None:
        """``codes`` has a row of code points per n-gram."""
        self.order = order = codes.shape[1]
        self.grams = _Table(_keys(codes), n0, n1)
        self.contexts = _Table(*_summed(_keys(codes[:, :-1]), n0, n1, n0 > 0, n1 > 0))
        # Shared continuation counts: in how many longer n-grams does a shorter one end? Kept
        # are the estimates of the n-grams that are there, and the share that each context
        # leaves to the next lower order.
        counts = []
        for _ in range(order - 1):
            keys, first, times = np.unique(
                _keys(codes[:, 1:]), return_index=True, return_counts=True
            )
            codes = codes[first, 1:]
            counts.insert(0, (keys, _keys(codes[:, :-1]), _keys(codes[:, 1:]), times))
        self.lower = []
        for keys, context, suffix, times in counts:
            contexts, total, kinds = _summed(context, times, times > 0)
            share = _Table(contexts, DISCOUNT * kinds / total)
            below = self.lower[-1][0].get(suffix)[0] if self.lower else 1 / ALPHABET
            where = np.searchsorted(contexts, context)
            own = np.maximum(times - DISCOUNT, 0) + DISCOUNT * kinds[where] * below
            self.lower.append((_Table(keys, own / total[where]), share))

    def arrays(self) -> tuple:
        """The model as plain arrays, which workers read without this package."""
        lower = [(table.arrays(), share.arrays()) for table, share in self.lower]
        return self.order, self.grams.arrays(), self.contexts.arrays(), lower

    @classmethod
    def of(cls, arrays: tuple) -> KneserNey:
        model = cls.__new__(cls)
        model.order, grams, contexts, lower = arrays
        model.grams, model.contexts = _Table.of(grams), _Table.of(contexts)
        model.lower = [(_Table.of(table), _Table.of(share)) for table, share in lower]
        return model

    def _shared(self, chain: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        """Estimates of the highest order that both classes share, at the given places."""
        p = np.ones(len(at))
        left = np.arange(len(at))
        for k in range(len(self.lower), 0, -1):
            table, share = self.lower[k - 1]
            place = table.find(chain[k][at[left]])
            known = place >= 0
            p[left[known]] *= table.values[0][place[known]]
            left = left[~known]
            if not len(left):
                return p
            place = share.find(chain[k - 1][at[left] - 1])
            p[left] *= np.where(place >= 0, share.values[0][place], 1)
        p[left] /= ALPHABET
        return p

    def evidence(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio, toxic to ordinary, of each word and its end."""
        n = self.order
        text = "".join([_START * (n - 1) + w + _END for w in words])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(w) + n for w in words])
        stops = np.cumsum(sizes)
        real = np.ones(len(codes), bool)
        for k in range(n - 1):
            real[stops - sizes + k] = False
        chain = _chain(codes, n)
        at = np.flatnonzero(real)
        place = self.contexts.find(chain[n - 1][at - 1])
        ratio = np.zeros(len(at))
        # A context that neither class has leaves both to the shared estimate.
        some = np.flatnonzero(place >= 0)
        place, seen = place[some], at[some]
        own = self.grams.get(chain[n][seen])
        p = self._shared(chain, seen)
        totals, kinds = self.contexts.values[:2], self.contexts.values[2:]
        for sign, c, total, kind in zip((-1, 1), own, totals, kinds, strict=True):
            total, kind = total[place].astype(np.float64), kind[place]
            mixed = (np.maximum(c - DISCOUNT, 0) + DISCOUNT * kind * p) / np.maximum(total, 1)
            ratio[some] += sign * np.log(np.where(total > 0, mixed, p))
        return np.add.reduceat(ratio, np.r_[0, np.cumsum(sizes - n + 1)[:-1]])


def _features(model: KneserNey, texts: list[str | None], known: dict[bytes, float]) -> np.ndarray:
    """Per text: evidence of the strongest word, mean of the three strongest, and per character."""
    out = np.zeros((len(texts), 3))
    for k, split in enumerate([words(t) for t in texts]):
        new = set(split).difference(known)
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set(split)
        new = list(new)
        for j in range(0, len(new), WORDS_AT_ONCE):
            part = new[j : j + WORDS_AT_ONCE]
            texts_ = [w.decode("utf-8", "replace") for w in part]
            known.update(zip(part, model.evidence(texts_).tolist(), strict=True))
        known[b""] = 0.0
        size = sum(map(len, split)) + len(split) - split.count(b"")
        if size:
            each = np.fromiter(map(known.__getitem__, split), np.float64, len(split))
            top = np.partition(each, -3)[-3:] if len(each) > 3 else each
            out[k] = top.max(), top.sum() / 3, each.sum() / size
    return out


def calibrate(
    features: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 0.3
) -> tuple[float, ...]:
    """Weights of a logistic curve over the features and a constant, by Newton's steps."""
    if not 0 < toxic.sum() < len(toxic):
        return PLAIN
    middle, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.c_[(features - middle) / spread, np.ones(len(features))]
    penalty = np.r_[np.full(features.shape[1], ridge), 1e-9]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        w -= np.clip(np.linalg.solve(curve, x.T @ (weight * (p - toxic)) + penalty * w), -3, 3)
    raw = w[:-1] / spread
    return (*map(float, raw), float(w[-1] - raw @ middle))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_PER_CLASS):
    """(model, weights): the models from most labelled rows, the curve from one more fold.

    What is collected here is bounded by the bounded sample of labelled documents. None
    if the labels lack a class.
    """
    rows = stage(labelled(docs, labels, limit), "labelled")
    table = grams(rows.where(F.col("part") != CALIBRATION)).select(
        F.encode("gram", "UTF-32").alias("gram"), "n0", "n1"
    ).toArrow()
    n0, n1 = (np.asarray(table[c]).astype(np.float32) for c in ("n0", "n1"))
    if not n0.sum() or not n1.sum():
        return None
    flat = [np.frombuffer(b"".join(c.to_pylist()), ">u4") for c in table["gram"].chunks]
    del table
    # Arrays, which a worker holds once for all its tasks, and not beside the bytes they came in.
    model = KneserNey(np.concatenate(flat).reshape(-1, ORDER), n0, n1).arrays()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    del model, flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = KneserNey.of(shared.value), {}
        for b in batches:
            f = _features(model, b["text"].to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [b["toxic"].cast(pa.int32()), b["weight"], *map(pa.array, f.T.copy())],
                names=["toxic", "weight", *FEATURES],
            )

    held = rows.where(F.col("part") == CALIBRATION).select("toxic", "weight", "text")
    found = held.mapInArrow(run, "toxic int, weight double, " + " double, ".join(FEATURES) + " double").toPandas()
    features = found[list(FEATURES)].to_numpy(float)
    return shared, calibrate(
        features, found["toxic"].to_numpy(float), found["weight"].to_numpy(float)
    )


def score_toxicity(
    docs: DataFrame, labels: DataFrame, limit: int = MAX_PER_CLASS
) -> DataFrame:
    """``docs`` with ``own(docs, "score")``, 0 to 1, higher where a toxic label is likelier.

    Scores come from the text alone. Labels (``doc_id``, ``toxic``) teach outside the
    held-out fold only. A NULL or empty text, or one without words, has features of 0.
    Without labels of both classes all scores are 0. All columns of ``docs`` pass through
    under their own names; equal texts have equal scores; an empty table stays empty.
    """
    bound_batches(docs.sparkSession)
    trained, name = train(docs, labels, limit), own(docs, "score")
    if trained is None:
        return docs.withColumn(name, F.lit(0.0))
    shared, weights = trained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = KneserNey.of(shared.value), {}
        for b in (b.slice(k, ROWS_AT_ONCE) for b in batches for k in range(0, b.num_rows, ROWS_AT_ONCE)):
            f = _features(model, b["text"].to_pylist(), known)
            z = np.clip(f @ np.array(weights[:-1]) + weights[-1], -500, 500)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())], names=[*b.schema.names, name]
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*kinds, f"`{name}` double"]))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    scored = score_toxicity(docs, labels)
    return scored.where(F.col(own(docs, "score")) < 0.5).select(*[f"`{c}`" for c in docs.columns])


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select(
        "doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.5).cast("int").alias("predicted"),
    )

from __future__ import annotations

import math
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from headway.llm import toxicity as op
from tests.llm.frames import DOCS, corpus, documents

LABELS = "doc_id long, toxic int, text string"


def ratio(words: list[Counter], word: str, order: int) -> float:
    """Interpolated Kneser-Ney by its definition, for one word and both classes."""
    grams = [Counter(), Counter()]
    for c in (0, 1):
        for w, n in words[c].items():
            s = op._START * (order - 1) + w + op._END
            for k in range(len(s) - order + 1):
                grams[c][s[k : k + order]] += n

    def estimate(table: Counter, g: str, below: float) -> float:
        same = [n for x, n in table.items() if x[:-1] == g[:-1]]
        if not same:
            return below
        own = max(table.get(g, 0) - op.DISCOUNT, 0)
        return (own + op.DISCOUNT * len(same) * below) / sum(same)

    tables, longer = {}, set(grams[0]) | set(grams[1])
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in longer)
        longer = set(tables[n])

    s, total = op._START * (order - 1) + word + op._END, 0.0
    for k in range(len(s) - order + 1):
        g, p = s[k : k + order], 1 / op.ALPHABET
        for n in range(1, order):
            p = estimate(tables[n], g[-n:], p)
        total += math.log(estimate(grams[1], g, p) / estimate(grams[0], g, p))
    return total


@pytest.mark.parametrize("order", [2, 5])
def test_evidence_is_kneser_ney(order):
    words = [Counter({"abc": 3, "abd": 1, "é中": 2, "b": 9}), Counter({"abx": 2, "b": 1})]
    table = {}
    for c in (0, 1):
        for w, n in words[c].items():
            s = op._START * (order - 1) + w + op._END
            for k in range(len(s) - order + 1):
                table.setdefault(s[k : k + order], [0, 0])[c] += n
    codes = np.array([[ord(x) for x in g] for g in table], np.uint32)
    n = np.array(list(table.values()), float)
    model = op.KneserNey(codes, n[:, 0], n[:, 1])
    asked = ["abc", "abx", "b", "unseen", "é", "ab"]
    assert model.evidence(asked) == pytest.approx([ratio(words, w, order) for w in asked], abs=1e-4)


def learnable(seed: int = 0):
    rng = np.random.default_rng(seed)
    ids, texts, toxic = list(range(1000, 1600)), [], []
    for k in ids:
        words = [f"w{x}" for x in rng.integers(0, 300, int(rng.integers(20, 200)))]
        toxic.append(int(k % 5 == 0))
        if toxic[-1]:
            words[int(rng.integers(0, 20))] = f"Vile{rng.integers(0, 99)}"
        texts.append(" ".join(words))
    return ids, texts, toxic


def test_toxic_documents_go_and_others_stay(spark):
    ids, texts, toxic = learnable()
    odd_ids, odd = corpus()
    labels = spark.createDataFrame(
        [(i, t, "x") for i, t in zip(ids, toxic, strict=True)]
        + [(1000, None, "x"), (None, 1, "x"), (1001, 0, "x"), (99999, 1, "x")], LABELS,
    )
    docs = documents(spark, [*texts, *odd], [*ids, *odd_ids])
    scored = op.score_toxicity(docs, labels)
    assert scored.columns == [*docs.columns, "___score"]
    scores = {r.rid: r["___score"] for r in scored.collect()}
    assert len(scores) == len(texts) + len(odd) and all(0 <= s <= 1 for s in scores.values())
    held = [k for k, i in enumerate(ids) if crc32(str(i).encode()) % 5 == 0]
    right = sum((scores[f"r{k}"] >= 0.5) == bool(toxic[k]) for k in held)
    assert right >= 0.97 * len(held)
    assert max(scores[f"r{len(texts) + k}"] for k, t in enumerate(odd) if not (t or "").strip()) < 0.5
    kept = {r.rid for r in op.keep_ordinary(docs, labels).collect()}
    assert kept == {k for k, s in scores.items() if s < 0.5} and len(kept) < len(scores)


def test_held_out_labels_teach_nothing(spark):
    ids, texts, toxic = learnable()
    turned = [1 - t if crc32(str(i).encode()) % 5 == 0 else t for i, t in zip(ids, toxic, strict=True)]
    docs = documents(spark, texts, ids)
    one, two = (
        {r.rid: r["___score"] for r in op.score_toxicity(
            docs, spark.createDataFrame([(i, t, "") for i, t in zip(ids, which, strict=True)], LABELS)
        ).collect()} for which in (toxic, turned)
    )
    assert one == two


def test_a_class_above_the_bound_is_sampled_and_weighted(spark):
    ids, texts, toxic = learnable()
    labels = spark.createDataFrame([(i, t, "") for i, t in zip(ids, toxic, strict=True)], LABELS)
    rows = op.labelled(documents(spark, texts, ids), labels, 100).groupBy("toxic").agg(
        {"weight": "sum", "*": "count"}
    ).collect()
    for r in rows:
        n = sum(t == r.toxic and crc32(str(i).encode()) % 5 > 0 for i, t in zip(ids, toxic, strict=True))
        assert r["sum(weight)"] == pytest.approx(n, rel=0.3) and r["count(1)"] <= max(130, 1)


def test_without_labels(spark):
    docs = documents(spark, ["a", None], [1, 2])
    rows = op.score_toxicity(docs, spark.createDataFrame([], LABELS)).collect()
    assert [r["___score"] for r in rows] == [0.0, 0.0]
    none = op.score_toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1, "")], LABELS))
    assert none.collect() == []


def test_workers_hold_the_model_once_and_hand_back_few_texts_at_a_time(spark):
    """Broadcast are plain arrays, not bytes to be read beside them; a model of them judges alike."""
    made = [(k, f"plain word {k % 9} text" if k % 2 else f"vile nasty {k % 9} muck", k % 2 ^ 1) for k in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in made], "doc_id long, toxic int")
    shared, _ = op.train(docs, labels)
    assert not isinstance(shared.value, bytes)
    codes = np.frombuffer("abcbcdabd".encode("utf-32-le"), "<u4").reshape(3, 3)
    model = op.KneserNey(codes, np.array([3.0, 1, 0]), np.array([0.0, 2, 5]))
    again = op.KneserNey.of(model.arrays())
    assert model.evidence(["ab", "bcd", "x"]).tolist() == again.evidence(["ab", "bcd", "x"]).tolist()


def test_long_texts_reach_workers_a_few_megabytes_at_a_time(spark):
    """A batch of 10,000 long texts is held once more by the executor and stays with its idle workers."""
    session = spark.newSession()
    docs = session.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 500) AS text")
    labels = session.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")

    def probe(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    op.score_toxicity(docs, labels)
    sizes = [r.n for r in docs.mapInArrow(probe, "n long").collect()]
    assert sum(sizes) > 12_000_000 and max(sizes) < 3_000_000
    session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    op.score_toxicity(docs, labels)
    assert session.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"


@pytest.mark.parametrize("n", [0, 1, 2, 300_000])
def test_a_table_finds_its_keys_and_is_indexed_in_little_room(n):
    rng = np.random.default_rng(3)
    keys = np.unique(np.r_[rng.integers(0, 2**64, n, np.uint64), np.array([0, 2**64 - 1], np.uint64)[:n]])
    table = op._Table(keys, np.arange(len(keys)))
    tracemalloc.start()
    table._index()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(keys) + 10_000
    others = np.setdiff1d(rng.integers(0, 2**64, 1000, np.uint64), keys)
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(others) == -1).all()

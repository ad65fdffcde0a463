from __future__ import annotations

import re

import numpy as np
import pytest

from headway.llm import near_join as op
from tests.llm.frames import DOCS, corpus, documents, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    return bool(a) and len(a & b) >= 0.8 * len(a | b) - 1e-9


def family(seed: int, n: int) -> list[str]:
    """Near copies of one text, each with a few words of its own."""
    rng = np.random.default_rng(seed)
    base = sentence(rng, 120, 10_000).split()
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 4))):
            words[at] = f"own{rng.integers(0, 10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("classes", [1500, 8])
def test_links_and_classes_as_by_brute_force(spark, classes, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_CLASSES", classes)
    ids, texts = corpus()
    texts = [*texts, *family(1, 40), *family(2, 5)]
    ids = [*ids, *range(500, 500 + len(texts) - len(ids))]
    sets = [shingles(t) for t in texts]
    order = [-(2**63) if i is None else i for i in ids]
    links = {k: [j for j in range(len(sets)) if j != k and similar(sets[k], sets[j])] for k in range(len(sets))}
    group = list(range(len(sets)))
    for _ in group:
        group = [min([group[k], *[group[j] for j in links[k]]]) for k in range(len(group))]
    rows = op.similar_documents(documents(spark, texts, ids)).collect()
    least = [min(order[j] for j in range(len(group)) if group[j] == group[k]) for k in range(len(group))]
    name = lambda i: None if i == -(2**63) else i
    expected = sorted((str(ids[k]), str(name(least[k])), len(links[k])) for k in range(len(ids)))
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in rows) == expected
    assert sum(r.kept for r in rows) == len(set(group))
    kept = op.keep_one_per_class(documents(spark, texts, ids))
    assert kept.columns == documents(spark, texts, ids).columns
    places = [int(r.rid[1:]) for r in kept.collect()]
    assert sorted(group[k] for k in places) == sorted(set(group))


def test_a_pair_is_dropped_only_if_it_is_hopeless():
    needed = op.matches_needed(0.8, op.STEP, op.BANDS * op.ROWS, op.TOLERANCE)
    rng = np.random.default_rng(0)
    for n, least in zip(range(op.STEP, 129, op.STEP), needed, strict=True):
        assert (rng.binomial(n, 0.8, 200_000) >= least).all() and least < 0.8 * n
    assert list(needed) == sorted(needed)


def test_no_rows(spark):
    assert op.similar_documents(spark.createDataFrame([], DOCS)).collect() == []
    assert op.keep_one_per_class(spark.createDataFrame([], DOCS)).collect() == []

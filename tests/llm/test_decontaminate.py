from __future__ import annotations

import re

import numpy as np
import pytest

from headway.llm import common
from headway.llm import decontaminate as op
from tests.llm.frames import DOCS, corpus, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string, rid string"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def plain(texts, items):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item_id, passage, _ in items:
            p = words(passage)
            for s in range(max(1, len(p) - 12)) if p else ():
                window = p[s : s + 13]
                for k in range(len(w) - len(window) + 1):
                    if w[k : k + len(window)] == window:
                        hit |= set(range(k, k + len(window)))
                        found.add(str(item_id))
        out.append((len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_hits_as_by_brute_force(spark, broadcast, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast)
    rng = np.random.default_rng(3)
    passages = [" ".join(f"w{k}" for k in rng.integers(0, 400, n)) for n in (13, 14, 40, 12, 5, 2)]
    passages += ["same " * 20, "w1", passages[0]]
    items = [(k, p, "x") for k, p in enumerate(passages)] + [(50, None, "x"), (51, " .", "x"), (3, passages[3], "y")]
    ids, texts = corpus()
    texts = [*texts]
    for k, p in enumerate(passages):
        texts[k] = f"{texts[k]} {p.upper()}, {texts[k]}"
    texts[10] = " ".join([passages[2][:60], "cut", passages[2][60:]])
    texts[11] = "same " * 45
    texts[-2] = f"{passages[2]} tail"
    texts[-1] = texts[-2]
    docs = documents(spark, texts, ids)
    found = op.find_contamination(docs, spark.createDataFrame(items, ITEMS)).collect()
    rows = sorted((str(r.rid), r.n_words, r.n_hit, r.items, r.contaminated, r.n_items) for r in found)
    want = plain(texts, items)
    key = lambda i: str(-(2**63) if i is None else i)
    assert rows == sorted((key(i), *w, len(w[2])) for i, w in zip(ids, want, strict=True))
    kept = op.drop_contaminated(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    assert sorted(r.rid for r in kept.collect()) == sorted(f"r{k}" for k, w in enumerate(want) if not w[3])


def test_terms_close_together(spark):
    docs = documents(spark, ["a x x b x c", "a x x x x x b c", "c b a", "a b", None])
    items = spark.createDataFrame([(1, "A b c a"), (2, "zzz a"), (3, None)], "item_id long, text string")
    index = op.build_index(docs, spark.createDataFrame([(w,) for w in "abc"], "term string"))
    got = op.proximity_matches(index, items, within=5).select("item_id", "rid", "pos").collect()
    assert sorted(map(tuple, got)) == [(1, 2, 0)]
    wide = op.proximity_matches(index, items, within=6).select("item_id", "rid", "pos").collect()
    assert sorted(map(tuple, wide)) == [(1, 0, 5), (1, 2, 0)]


def test_no_rows(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert op.find_contamination(none, items).collect() == []
    (row,) = op.find_contamination(documents(spark, ["a b"]), items).collect()
    assert (row.n_words, row.n_hit, row.items, row.contaminated) == (2, 0, [], False)

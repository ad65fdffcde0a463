from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from headway.llm import ctw as op
from tests.llm.frames import DOCS, corpus, documents

LOW = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tree_scores(train: list[bytes], score: list[bytes]) -> list[float]:
    """Context-tree weighting by its definition, counts in a dictionary, sequential estimates."""
    d = op.DEPTH
    counts, log_e = defaultdict(lambda: [0, 0]), defaultdict(float)

    def steps(text):
        data = bytes([op.EDGE]) * d + text + bytes([op.EDGE])
        for at in range(d, len(data)):
            node = 1
            for k in range(7, -1, -1):
                bit = data[at] >> k & 1
                yield [(data[at - n : at], node) for n in range(d + 1)], bit
                node = node * 2 + bit

    for text in train:
        for path, bit in steps(text):
            for s in path:
                c = counts[s]
                log_e[s] += math.log((c[bit] + 0.5) / (sum(c) + 1))
                c[bit] += 1
    children = defaultdict(list)
    for context, node in list(counts):
        if context:
            children[context[1:], node].append((context, node))
    log_w = {}
    for s in sorted(counts, key=lambda s: -len(s[0])):
        below = sum(log_w[c] for c in children[s])
        log_w[s] = log_e[s] if len(s[0]) == d else np.logaddexp(log_e[s], below) - math.log(2)
    out = []
    for text in score:
        total = 0.0
        for path, bit in steps(text):
            p = None
            for s in reversed(path):
                c = counts.get(s, [0, 0])
                own = (c[bit] + 0.5) / (sum(c) + 1)
                w = math.exp(log_e.get(s, 0.0) - math.log(2) - log_w.get(s, 0.0))
                p = own if p is None else w * own + (1 - w) * p
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize("block", [16_000_000, 300])
def test_scores_follow_the_definition(spark, block, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_BYTES", block)
    monkeypatch.setattr(op, "DENSE", 3000 if block == 300 else op.DENSE)
    monkeypatch.setattr(op, "PART", 100 if block == 300 else op.PART)
    monkeypatch.setattr(op, "OWNED", 20 if block == 300 else op.OWNED)
    ids, texts = corpus()
    keep = [k for k, t in enumerate(texts) if len(t or "") < 1000]
    ids, texts = [ids[k] for k in keep], [texts[k] for k in keep]
    held = [crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i in ids]
    assert any(held) and not all(held)
    plain = [(t or "").translate(LOW) for t in texts]
    words = [WORD.findall(t) + [None] for t in plain]
    c = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n = sum(c.values())
    expected = tree_scores([t.encode() for t, h in zip(plain, held, strict=True) if not h], [t.encode() for t in plain])
    rows = op.score_documents(documents(spark, texts, ids)).collect()
    want = [
        (i, h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + len(c) + 1)) for x in w), s)
        for i, h, w, s in zip(ids, held, words, expected, strict=True)
    ]
    order = lambda r: (str(r[0]), r[2], r[6])
    for got, wanted in zip(sorted(map(tuple, rows), key=order), sorted(want, key=order), strict=True):
        assert got[:5] == wanted[:5]
        assert got[5:] == pytest.approx(wanted[5:], rel=1e-9)


def test_probabilities_sum_to_one(spark):
    """Over all last bytes of one context, in an n-gram table that holds them."""
    context = int.from_bytes(b"abcde", "big")
    keys = (context << 8) | np.arange(256)
    n = np.where(keys & 255 == 120, 5, np.where(keys & 255 == 121, 1, 0))
    columns = op._trees(keys, n)[1]
    nodes = spark.createDataFrame(
        list(zip(*[c.tolist() for c in columns], strict=True)),
        "context long, node long, weighted double, zeros double, ones double",
    )
    prices = op.code_lengths(keys, n, op._upper(nodes))
    assert (10**prices).sum() == pytest.approx(1, rel=1e-9)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7, 1e3, 1e9])
    assert op._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-11)


def test_few_rows(spark):
    assert op.score_documents(spark.createDataFrame([], DOCS)).collect() == []
    only = next(i for i in range(99) if crc32(str(i).encode()) % 7 == 2)
    (row,) = op.score_documents(documents(spark, ["a b"], [only])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.score == pytest.approx(4 * 8 * math.log10(0.5)) and row.base_score == pytest.approx(0)

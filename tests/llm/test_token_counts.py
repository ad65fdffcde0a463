from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from headway.llm import token_counts as op
from tests.llm.frames import DOCS, corpus, documents

ENCODING = op.load_encoding(public_tokenizers.path(op.VOCABULARY))
PARTS = [*"ab'strel 1.,\n\t  ", "'s", " the", " don't", "é", "  ", "\n\n", "中", "_", "\x1c", "\u2003"]


def applied(text: str, edits) -> str:
    for start, stop, new in edits:
        start = min(max(start or 0, 0), len(text))
        text = text[:start] + (new or "") + text[max(min(stop or 0, len(text)), start) :]
    return text


@pytest.mark.parametrize("leaf", [1, 5, 40])
def test_any_edits_count_like_the_whole_text(leaf, monkeypatch):
    monkeypatch.setattr(op, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    for _ in range(200):
        text = "".join(rng.choice(PARTS, rng.integers(0, 120)))
        tree = op.TokenTree(text, ENCODING)
        for _ in range(8):
            start = int(rng.integers(-1, len(text) + 3))
            edit = (start, start + int(rng.integers(-1, 9)), "".join(rng.choice(PARTS, rng.integers(0, 6))))
            text = applied(text, [edit])
            tree.edit(*edit)
            assert tree.text() == text and tree.chars == len(text)
            assert tree.tokens == len(ENCODING.encode_ordinary(text))


def test_an_edit_encodes_a_small_part():
    tree = op.TokenTree("some words in a long text " * 4000, ENCODING)
    tree.encoded = 0
    tree.edit(50_000, 50_003, "other")
    assert tree.encoded < 4 * op.LEAF


def test_documents_with_edit_logs(spark):
    ids, texts = corpus()
    log = [(100, 1, 5, 9, "x"), (100, 0, 0, 0, "y z"), (101, 0, None, 4, None), (7, 0, 10**6, 10**6, " end"), (None, 0, 0, 0, "n")]
    edits = spark.createDataFrame(log, "doc_id long, seq int, start int, stop int, text string")
    docs = op.attach_edits(documents(spark, texts, ids), edits)
    assert op.attach_edits(documents(spark, texts, ids), edits.limit(0)).count() == len(ids)
    by = {i: [e[2:] for e in sorted((e for e in log if e[0] == i), key=lambda e: e[1])] for i in ids if i is not None}
    count = lambda t: len(ENCODING.encode_ordinary(t))
    expected = []
    for i, t in zip(ids, texts, strict=True):
        after = applied(t or "", by.get(i, []))
        expected.append((i, len(by.get(i, [])), count(t or ""), count(after), len(after), after))
    rows = op.count_tokens(docs).drop("n_chars_encoded").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_the_logs_of_the_query(spark):
    ids, texts = corpus()
    texts[4] = "mail to some.one@example.org, or not"
    docs = documents(spark, texts, ids).withColumn("source", F.col("lang"))
    rows = op.count_tokens(docs.withColumn("edits", op.redaction_edits())).collect()
    for r in rows:
        assert r.text_edited.startswith("source: en\n") and r.text_edited.endswith(" (end of document)")
        assert r.n_tokens_edited == len(ENCODING.encode_ordinary(r.text_edited))
    assert not any("@" in r.text_edited for r in rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCS).withColumn("edits", F.lit(None).cast(op.EDITS))
    assert op.count_tokens(docs).collect() == []

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from headway.llm import alignment as op
from tests.llm.frames import DOCS, corpus, documents, sentence

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.fixture(scope="module")
def aligner():
    return op.Aligner(public_tokenizers.path(op.LEFT), public_tokenizers.path(op.RIGHT))


def brute_force(aligner, rows):
    """Whole texts, token ranges compared pair by pair."""
    made, total = [], Counter()
    for doc_id, text in rows:
        data = f" {text}".encode() if text else b""
        ids_a = aligner.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = aligner.b.encode(text) if text else []
        sides = []
        for ids, known in ((ids_a, aligner.bytes_a), (ids_b, aligner.bytes_b)):
            ends = np.cumsum([len(known[k]) for k in ids]).tolist()
            sides.append((ids, [0, *ends[:-1]] if ends else [], ends, b"".join([known[k] for k in ids])))
        (a, sa, ea, da), (b, sb, eb, db) = sides
        if not text or da != data or db != data:
            made.append((doc_id, [], [], "", []))
            continue
        links, first = [], 0
        for i in range(len(a)):
            while eb[first] <= sa[i]:
                first += 1
            j = first
            while j < len(b) and sb[j] < ea[i]:
                links.append((a[i], b[j]))
                j += 1
        both = sorted(set(ea) & set(eb))
        group = lambda ids, ends, lo, hi: ",".join(str(k) for k, e in zip(ids, ends, strict=True) if lo < e <= hi)
        if len(text) > 5000:
            names = None
        else:
            names = ";".join(f"{group(a, ea, lo, hi)}|{group(b, eb, lo, hi)}" for lo, hi in zip([0, *both], both, strict=False))
        made.append((doc_id, a, b, (names, len(both)), links))
        total.update(links)
    best = Counter()
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, groups, links in made:
        names, n_groups = groups or ("", 0)
        sha = None if names is None else hashlib.sha256(names.encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), n_groups, len(links), sha,
                    sum(total[p] == best[p[1]] for p in links), sum(total[p] for p in links)))
    return out


ODD = [
    " ", "  ", "\n", "a", " lead", "trail ", "two  blanks", "three   blanks and    four", "tab\tand \t mixed\t ",
    "line\nbreak", "line \n break", "para\n\ngraph", "three\n\n\nlines\n \n \nand", "\n\nstart", "end\n", "\r\nwin\r\n dos\r\r",
    "nbsp  x  y 　 z", "  sep   ", "under▁score", "▁", "\x1c \x1fctl \x00 nul",
    "<|endoftext|> <s> </s> <0x41> <unk>", "emoji 😀😀 ß ﬁ é 中文字 한국어 العربية", "don't I'll we've 's 're", "x" * 3000,
    "中文" * 800, "A.B,C;D(E)[F] --- ... !!!", "1234567 12,345.67 0x1F", "𝒳 ﻿ bom", "a\n b\n  c\n\t d",
]


@pytest.mark.parametrize("small", [False, True])
def test_as_by_brute_force(spark, aligner, small, monkeypatch):
    if small:
        monkeypatch.setattr(op, "BLOCK_STRETCHES", 40)
        monkeypatch.setattr(op, "KNOWN", 30)
    rng = np.random.default_rng(0)
    ids, texts = corpus()
    alphabet = [" ", " ", "\n", "\t", "a", "b", ".", "'s", "9", "é", "中", " ", "\r", "word", "　", "-"]
    noise = ["".join(rng.choice(alphabet, int(n))) for n in rng.integers(1, 40, 120)]
    texts = [*texts, *ODD, *noise]
    ids = [*ids, *range(5000, 5000 + len(ODD) + len(noise))]
    df = documents(spark, texts, ids)
    got = sorted(map(tuple, op.align_documents(df).select(*NAMES).collect()), key=str)
    expected = brute_force(aligner, list(zip(ids, texts, strict=True)))
    assert len(got) == len(expected)
    for g, e in zip(got, sorted(expected, key=str), strict=True):
        assert g[:5] + g[6:] == e[:5] + e[6:]
        assert e[5] is None or g[5] == e[5]


def test_any_text_is_the_sum_of_its_stretches(aligner):
    rng = np.random.default_rng(1)
    alphabet = [" ", " ", "  ", "\n", "\t", "ab", "The", "!", "'ll", "7", "ß", "字", " ", "\x0b", "<s>"]
    for n in rng.integers(1, 30, 3000):
        text = "".join(rng.choice(alphabet, int(n)))
        at = aligner.stretches(text)
        joined = ";".join(aligner.groups[k] for k in at)
        a = aligner.a.encode(f" {text}", add_special_tokens=False).ids
        b = aligner.b.encode(text)
        ends = [np.cumsum([len(known[k]) for k in ids]).tolist() for ids, known in ((a, aligner.bytes_a), (b, aligner.bytes_b))]
        groups, _ = op.align(a, ends[0], b, ends[1])
        assert joined == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups), repr(text)


def test_very_long_texts(spark, aligner):
    rng = np.random.default_rng(2)
    rows = [(1, sentence(rng, 60_000, 9000)), (2, "z" * 60_000), (3, "\n".join(["a b"] * 20_000))]
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(map(tuple, op.align_documents(df).select(*NAMES).collect()))
    for g, e in zip(got, brute_force(aligner, rows), strict=True):
        assert g[:5] + g[6:] == e[:5] + e[6:]


def test_no_rows(spark):
    assert op.align_documents(spark.createDataFrame([], DOCS)).collect() == []

"""Small tables with the cases that every operator has to stand."""

from __future__ import annotations

import numpy as np

DOCS = "doc_id long, text string, lang string, rid string, __score string, __th string, th string"


def sentence(rng: np.random.Generator, n: int, words: int = 400) -> str:
    return " ".join([f"w{k}" for k in rng.integers(0, words, n)])


def documents(spark, texts, ids=None):
    """Documents whose other columns have names that operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"r{k}", "s", "t", "h") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def corpus(seed: int = 0) -> tuple[list, list]:
    """(ids, texts) with NULLs, empty and long texts, ties, copies and repeated rows."""
    rng = np.random.default_rng(seed)
    base = [sentence(rng, int(n)) for n in rng.integers(3, 60, 25)]
    near = [f"{base[0]} one more", base[1].upper(), base[1] + "!", base[2].replace(" ", "\n")]
    odd = [None, "", " ", "\n", "one", "Straße 中文 ñandú", "a b c d", "a b c d", "\x00 \x1c .,;"]
    long = [sentence(rng, 30_000, 5000)]
    texts = [*base, *near, *odd, *long, base[3], base[3]]
    ids = [*range(100, 100 + len(texts) - 3), None, 7, 7]
    return ids, texts

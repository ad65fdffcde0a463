from __future__ import annotations

import pickle
import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from pyspark import cloudpickle
from tokenizers import Tokenizer

from headway.llm import packing as op
from tests.llm.frames import DOCS, corpus, documents

PATH = public_tokenizers.path(op.VOCABULARY)


def whole(text) -> list[int]:
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [op.END_ID]


def test_word_by_word_equals_the_whole_text():
    words, tokenizer = op.WordIds(PATH), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(0)
    parts = list("ab'sdIKÅ \n\t\r\x1c\x85́ 1½<|>,._🙂İßﬁ中") + ["<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "don't.", "x,"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        ids = np.frombuffer(words.encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [16, 2048])
def test_every_piece_has_its_place(spark, capacity):
    ids, texts = corpus()
    rows = op.pack_sequences(documents(spark, texts, ids), capacity=capacity).collect()
    expected = []
    for i, text in zip(ids, texts, strict=True):
        tokens = whole(text)
        for k in range(0, len(tokens), capacity):
            part = tokens[k : k + capacity]
            expected.append((i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted([tuple(r)[:5] for r in rows], key=str) == sorted(expected, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) <= -(-sum(e[3] for e in expected) // capacity) + 1


def least_bins(sizes: list[int], capacity: int) -> int:
    """By brute force over the bins that hold the largest piece."""
    if not sizes:
        return 0
    top, *rest = sorted(sizes, reverse=True)
    best = len(sizes)
    for n in range(min(len(rest), capacity) + 1):
        for chosen in set(combinations_with_replacement(sorted(set(rest)), n)):
            left = list(rest)
            if sum(chosen) + top <= capacity and all(left.count(c) >= chosen.count(c) for c in chosen):
                for c in chosen:
                    left.remove(c)
                best = min(best, 1 + least_bins(left, capacity))
    return best


def test_bin_completion_is_as_good_as_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = rng.integers(2, 11, 7).tolist()
        counts = np.bincount(sizes, minlength=12)
        packing, bound = op.complete_bins(counts, 11)
        used = np.zeros(12, int)
        for filling, n in packing:
            assert sum(filling) <= 11
            for x in filling:
                used[x] += n
        assert (used == counts).all()
        assert bound <= sum(n for _, n in packing) == least_bins(sizes, 11)


def test_no_rows(spark):
    assert op.pack_sequences(spark.createDataFrame([], DOCS)).collect() == []


def exact_bins(sizes: list[int], capacity: int) -> int:
    """Fewest bins, by dynamic programming over subsets."""
    best = [(len(sizes) + 1, 0)] * (1 << len(sizes))
    best[0] = (1, 0)
    for held, (bins, used) in enumerate(best):
        for k, size in enumerate(sizes):
            if not held >> k & 1:
                put = (bins, used + size) if used + size <= capacity else (bins + 1, size)
                best[held | 1 << k] = min(best[held | 1 << k], put)
    return best[-1][0]


def test_branch_and_bound_equals_the_exact_optimum():
    rng = np.random.default_rng(5)
    cases = [(184, [29, 38, 42, 48, 50, 60, 63, 71, 76, 76, 81, 92])]
    while len(cases) < 60:
        capacity = int(rng.integers(60, 400))
        sizes = rng.integers(capacity // 7, capacity // 2 + 1, 12).tolist()
        counts = np.bincount(sizes, minlength=capacity + 1)
        if sum(n for _, n in op.best_fit(counts, capacity)) > op.lower_bound(counts, capacity):
            cases.append((capacity, sizes))
    for capacity, sizes in cases:
        packing, bound = op.complete_bins(np.bincount(sizes, minlength=capacity + 1), capacity)
        assert sorted(x for f, n in packing for x in f * n) == sorted(sizes)
        assert all(sum(f) <= capacity for f, _ in packing)
        assert bound <= sum(n for _, n in packing) == exact_bins(sizes, capacity)


def test_a_search_that_ends_early_still_packs_everything():
    sizes = np.random.default_rng(2).integers(520, 1000, 3000)
    packing, bound = op.complete_bins(np.bincount(sizes, minlength=2049), 2048, steps=5000)
    assert sorted(x for f, n in packing for x in f * n) == sorted(sizes.tolist())
    assert sum(n for _, n in packing) >= bound


def test_remembered_words_take_bounded_room(monkeypatch):
    monkeypatch.setattr(op, "CACHED_BYTES", 200_000, raising=False)
    words, tokenizer = op.WordIds(PATH), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(3)
    for k in range(60):
        long = "".join(rng.choice(list("abcdef123"), 5_000))
        text = " ".join(["the cat,", long, *(f"w{k}x{j}." for j in range(40)), "the cat,"])
        ids = np.frombuffer(words.encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
        assert sum(len(w) + len(ids) for w, ids in words.known.items()) <= 200_000
    assert b"the" in words.known  # met first, so it stays


def test_a_word_longer_than_all_room_is_forgotten(monkeypatch):
    monkeypatch.setattr(op, "CACHED_BYTES", 1000, raising=False)
    words = op.WordIds(PATH)
    for text in ("b1" * 3000, "x y", "b1" * 3000 + " z"):
        ids = np.frombuffer(words.encode(text), "<u4").tolist()
        assert [*ids, op.END_ID] == whole(text)
        assert sum(map(len, words.known)) <= 1000


def test_tasks_of_a_worker_share_words():
    assert pickle.loads(cloudpickle.dumps(op.word_ids))(PATH) is op.word_ids(PATH)


def test_texts_travel_in_small_batches_unless_the_session_names_a_bound(spark):
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    session = spark.newSession()
    op.pack_sequences(session.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert session.conf.get(bound) == "2m"
    session.conf.set(bound, "1m")
    op.pack_sequences(session.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert session.conf.get(bound) == "1m"

from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st

from headway.llm import chat as op

TURNS = "conv_id long, turn long, role string, text string, turns string, formatted string"
PIECES = ["<|im_end|>", "<|im_start|>", "\n", "\\", "|", "<|", "n", "<\\|im_end|>", "a", "é", "<", "\\n", "<|im_end|>\n"]
texts = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(texts, st.sampled_from(["user", "assistant"])), texts), max_size=5))
def test_any_turns_read_back(turns):
    text, spans = op.format_turns(turns)
    assert [t[:2] for t in op.parse(text)] == turns
    learned = [op.unescape(text[s:e]) for s, e in spans]
    assert learned == [t for r, t in turns if r == "assistant"]
    assert text.count(op.START) == text.count(op.END) == len(turns)


def test_ordinary_text_stays_as_it_is():
    text, _ = op.format_turns([("user", "a < b | c \\x"), ("assistant", "")])
    assert text == "<|im_start|>user\na < b | c \\x<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"


def test_broken_text_does_not_parse():
    good, _ = op.format_turns([("user", "hi")])
    for bad in (good[1:], good[:-1], good + "x", good.replace("\n", ""), good + op.END, "x"):
        assert op.parse(bad) is None


def test_odd_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, None, "z"), (1, None, "user", "first"),
            (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, 0, "user", "x"), (None, 1, "user", "y")]
    df = spark.createDataFrame([(*r, "t", "f") for r in rows], TURNS)
    back = {r.conv_id: r for r in op.read_conversations(op.format_conversations(df)).collect()}
    turns = {k: [(t.role, t.text) for t in r.turns] for k, r in back.items()}
    assert turns == {
        1: [("user", "first"), ("", "z"), ("user", ""), ("assistant", "b")],
        2: [("assistant", "same")] * 2, None: [("user", "x"), ("user", "y")],
    }
    assert [back[k].learned for k in (1, 2, None)] == ["b", "samesame", ""]
    assert op.format_conversations(spark.createDataFrame([], TURNS)).collect() == []

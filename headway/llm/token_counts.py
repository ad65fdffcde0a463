"""Token counts that follow edits.

A document is kept as a tree over runs of pre-tokens: leaves hold text and its token count,
inner nodes the sums below them. An edit encodes again only the leaves that it touches, and a
neighbour where the boundary between them is no longer sure, then updates the sums above.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Code points in a leaf, about; leaves that edits make eight times as long are cut anew.
LEAF = 400
#: A blank between a letter or digit and a letter: a pre-token starts here, whatever else
#: the text holds.
_SURE = re.compile(r"(?<=[^\W_]) (?=[^\W\d_])")

EDITS = "array<struct<start: int, stop: int, text: string>>"
_COUNTS = (
    "doc_id long, n_edits int, n_tokens long, n_tokens_edited long, n_chars_edited long, "
    "n_chars_encoded long, text_edited string"
)


def load_encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


class TokenTree:
    """Sums of code points and tokens over the leaves of one text."""

    def __init__(self, text: str, encoding) -> None:
        self.encoding = encoding
        self.encoded = 0
        self._build(text)

    def _build(self, text: str) -> None:
        self.leaves, at = [], 0
        while at < len(text):
            cut = _SURE.search(text, at + LEAF)
            stop = cut.start() if cut else len(text)
            self.leaves.append(text[at:stop])
            at = stop
        self.leaves = self.leaves or [""]
        level = [(len(t), n) for t, n in zip(self.leaves, self._count(self.leaves), strict=True)]
        self.levels = [level]
        while len(level) > 1:
            pairs = zip(level[::2], [*level[1::2], (0, 0)], strict=False)
            level = [(a[0] + b[0], a[1] + b[1]) for a, b in pairs]
            self.levels.append(level)

    def _count(self, texts: list[str]) -> list[int]:
        self.encoded += sum(map(len, texts))
        return [len(self.encoding.encode_ordinary(t)) for t in texts]

    @property
    def chars(self) -> int:
        return self.levels[-1][0][0]

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds a place, and where it begins."""
        leaf = begin = 0
        for level in reversed(self.levels[:-1]):
            leaf *= 2
            if at >= begin + level[leaf][0] and leaf + 1 < len(level):
                begin += level[leaf][0]
                leaf += 1
        return leaf, begin

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        self.levels[0][leaf] = (len(text), tokens)
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            leaf //= 2
            a = below[2 * leaf]
            b = below[2 * leaf + 1] if 2 * leaf + 1 < len(below) else (0, 0)
            level[leaf] = (a[0] + b[0], a[1] + b[1])

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace the code points from ``start`` to ``stop``; places beyond the ends are the ends."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        first, begin = self._find(start)
        last, last_begin = self._find(stop)
        end = last_begin + len(self.leaves[last])
        old = "".join(self.leaves[first : last + 1])
        new = old[: start - begin] + text + old[stop - begin :]
        # The left boundary is sure if its blank and the letter after it stand as before.
        while first and (start < begin + 2 or not _SURE.match(self._before(first) + new[:2], 1)):
            first -= 1
            begin -= len(self.leaves[first])
            new = self.leaves[first] + new
        # The right one is, if what now stands before it is a letter or digit.
        while last + 1 < len(self.leaves) and not _SURE.match(new[-1:] + self._after(last), 1):
            last += 1
            new += self.leaves[last]
            end += len(self.leaves[last])
        self._set(first, new, self._count([new])[0])
        for k in range(first + 1, last + 1):
            self._set(k, "", 0)
        if len(new) > 8 * LEAF:
            self._build(self.text())

    def _before(self, leaf: int) -> str:
        """The last code point before a leaf."""
        while leaf and not self.leaves[leaf - 1]:
            leaf -= 1
        return self.leaves[leaf - 1][-1:] if leaf else ""

    def _after(self, leaf: int) -> str:
        """The first two code points after a leaf."""
        found = ""
        while leaf + 1 < len(self.leaves) and len(found) < 2:
            leaf += 1
            found += self.leaves[leaf][:2]
        return found[:2]


def attach_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """``docs`` with a column of the edits in ``edits(doc_id, seq, start, stop, text)``."""
    edit = F.struct("seq", F.struct("start", "stop", "text").alias("edit"))
    logs = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(edit)).alias("log"))
    logs = logs.select("doc_id", F.transform("log", lambda x: x["edit"]).cast(EDITS).alias("edits"))
    return docs.join(logs, "doc_id", "left")


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token counts of ``docs(doc_id, text, edits)`` before and after each row's edits.

    ``edits`` are applied in order; start and stop are code points of the text as it then is,
    and places beyond its ends are its ends. A NULL text is empty, a NULL list has no edits,
    NULL starts or stops are 0, a NULL replacement is empty. Every row is a document, also
    when rows repeat or ids are NULL. ``n_chars_encoded`` is what was encoded after the
    first count. Other columns are not used. An empty table gives an empty table.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path)
        for b in batches:
            rows = []
            for doc_id, text, edits in zip(b["doc_id"].to_pylist(), b["text"], b["edits"], strict=True):
                tree = TokenTree(text.as_py() or "", encoding)
                before, tree.encoded, log = tree.tokens, 0, edits.as_py() or []
                for e in log:
                    tree.edit(e["start"] or 0, e["stop"] or 0, e["text"] or "")
                rows.append((doc_id, len(log), before, tree.tokens, tree.chars, tree.encoded, tree.text()))
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string())
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in _COUNTS.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", F.col("edits").cast(EDITS)).mapInArrow(
        run, _COUNTS
    )


def redaction_edits() -> Column:
    """An edit log out of a document itself, last place first: an end mark, a cut in the
    middle, its first e-mail address masked, and a line on where it comes from."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    address = r"[\w.+-]+@[\w-]+(\.[\w-]+)+"
    at = F.regexp_instr(text, F.lit(address)) - 1
    edit = lambda start, stop, new: F.struct(
        start.cast("int").alias("start"), stop.cast("int").alias("stop"), new.alias("text")
    )
    middle = F.floor(n / 2)
    head = F.concat(F.lit("source: "), F.coalesce("source", F.lit("")), F.lit("\n"))
    log = F.array(
        edit(n, n, F.lit(" (end of document)")),
        F.when(n > 40, edit(middle, middle + 17, F.lit(""))),
        F.when(at >= 0, edit(at, at + F.length(F.regexp_extract(text, address, 0)), F.lit("<address>"))),
        edit(F.lit(0), F.lit(0), head),
    )
    return F.filter(log, lambda e: e.isNotNull()).cast(EDITS)


def op1_token_counts(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs.withColumn("edits", redaction_edits())).drop("text_edited")

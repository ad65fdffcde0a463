from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from headway.llm import archive as op

PAGES = "page_id long, url string, html string, payload string"
BIG = "x" * 100


def test_types_and_digests(spark):
    pages = [
        (5, "u", BIG, "a"), (3, "a\r\nWARC-Type: revisit\r\nb%41", BIG, "b"), (9, None, BIG, "c"),
        (1, "u", "short", "d"), (2, "u", "short", "e"), (4, "u", None, "f"), (6, "u", "", "g"),
        (None, "u", "é" * 60, "h"), (8, "u", "é" * 60, "i"), (None, "n", "z" * 200, "j"),
        (7, "u", "r\r\n\r\nWARC-Type: revisit\r\n" * 9, "k"), (7, "u", "r\r\n\r\nWARC-Type: revisit\r\n" * 9, "k"),
    ]
    df = spark.createDataFrame(pages, PAGES)
    archive = op.write_archive(df)
    assert archive.payloads.count() == len({p[2] or "" for p in pages})
    records = op.read_archive(archive)
    rows = op.parse_records(records).collect()
    first = {}
    for p in pages:
        if p[0] is not None:
            first[p[2] or ""] = min(p[0], first.get(p[2] or "", p[0]))

    def expected(p):
        data = (p[2] or "").encode()
        lead = first.get(p[2] or "")
        again = len(data) >= 100 and lead is not None and p[0] != lead
        return (p[0], p[1], len(data), sha256(data).hexdigest(), "revisit" if again else "response",
                lead if again else None)

    assert sorted(map(tuple, rows), key=str) == sorted(map(expected, pages), key=str)
    for r in op.record_bytes(records).collect():
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert len(body) == length + 4


def test_a_damaged_payload_is_noticed(spark):
    archive = op.write_archive(spark.createDataFrame([(1, "u", BIG, "")], PAGES))
    bad = op.Archive(archive.records, archive.payloads.withColumn("payload", F.lit(b"other")))
    with pytest.raises(Exception, match="damaged payload"):
        op.read_archive(bad).collect()


def test_no_rows(spark):
    archive = op.write_archive(spark.createDataFrame([], PAGES))
    assert op.parse_records(op.read_archive(archive)).collect() == []

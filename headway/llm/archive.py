"""A content-addressed web archive.

Payload bytes are stored once per SHA-256, record headers apart from them, byte for byte.
Records are rebuilt by a join of the two tables on the digest, and each stored payload is
hashed again when it is read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stage

#: Payloads shorter than this are always written as responses.
MIN_REVISIT_BYTES = 100
CRLF = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header values hold no line ends; these are percent-encoded, and so is the sign itself.
_ENCODED = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"))


class Archive(NamedTuple):
    """``records(page_id, payload_digest, header)`` and ``payloads(payload_digest, payload)``."""

    records: DataFrame
    payloads: DataFrame


def _encode(value: Column) -> Column:
    for raw, code in _ENCODED:
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def _decode(value: Column) -> Column:
    for raw, code in reversed(_ENCODED):
        value = F.replace(value, F.lit(code), F.lit(raw))
    return value


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES) -> Archive:
    """Write a record per row of ``pages(page_id, url, html)``; NULL html is an empty payload.

    Of records with equal payloads of at least ``min_revisit`` bytes, those with the smallest
    page_id are responses and the others revisit it; shorter payloads are all responses.
    Rows that repeat the smallest page_id are responses too. A NULL page_id never is the one
    referred to unless all of a payload's are NULL, and then all are responses. Further
    columns of ``pages`` are not archived.

    Equal payloads meet in an aggregate that keeps one copy per task before the shuffle, so
    a payload that a third of all pages carry moves once per task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    named = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "payload_digest", F.sha2("payload", 256)
    )
    payloads = stage(
        named.groupBy("payload_digest").agg(
            F.first("payload").alias("payload"), F.min("page_id").alias("first_page")
        ),
        "warc-payloads",
    )
    refs = payloads.select(
        "payload_digest", "first_page", F.octet_length("payload").cast("long").alias("n")
    )
    records = named.select("page_id", "url", "payload_digest").join(refs, "payload_digest")
    revisit = (
        (F.col("n") >= min_revisit)
        & F.col("first_page").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    )
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    ref = F.when(revisit, record_id(F.col("first_page")))
    header = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", record_id(F.col("page_id"))),
        _line("WARC-Target-URI", _encode(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _line("WARC-Refers-To", ref),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
        F.lit(CRLF),
    )
    records = records.select("page_id", "payload_digest", F.encode(header, "UTF-8").alias("header"))
    return Archive(stage(records, "warc-records"), payloads.select("payload_digest", "payload"))


def read_archive(archive: Archive) -> DataFrame:
    """Every record again: (header, block, payload), bytes as written.

    ``block`` is the record's own content block (empty for a revisit), ``payload`` the full
    payload it stands for. A stored payload whose bytes do not hash to its digest raises.
    """
    sound = F.sha2("payload", 256) == F.col("payload_digest")
    checked = archive.payloads.select(
        "payload_digest",
        F.when(sound, F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), "payload_digest"))
        ).alias("payload"),
    )
    kind = F.regexp_extract(F.decode("header", "UTF-8"), r"WARC-Type: (\w+)\r\n", 1)
    return archive.records.join(checked, "payload_digest", "left").select(
        "header",
        F.when(kind == "revisit", F.lit(b"")).otherwise(F.col("payload")).alias("block"),
        "payload",
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """The records as they stand in a WARC file: header, block, two line ends."""
    return records.select(F.concat("header", "block", F.lit(b"\r\n\r\n")).alias("record"))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields out of headers and bytes: page_id, url, payload size and digest, type, refers_to."""
    head = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        found = F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
        return F.when(F.contains(head, F.lit(f"\r\n{name}: ")), found)

    page = lambda name: F.nullif(
        F.regexp_extract(field(name), r"^<urn:page:(-?\d*)>$", 1), F.lit("")
    ).cast("long")
    return records.select(
        page("WARC-Record-ID").alias("page_id"),
        _decode(field("WARC-Target-URI")).alias("url"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
    )


def op3_warc(spark, sf_dir) -> DataFrame:
    archive = write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return parse_records(read_archive(archive)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


SQL = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_page FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes, digest AS payload_digest,
  CASE WHEN octet_length(payload) >= 100 AND page_id <> first_page
    THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(payload) >= 100 AND page_id <> first_page THEN first_page END AS refers_to,
  url
FROM f
"""

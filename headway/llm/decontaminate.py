"""Benchmark passages in a corpus, found over a positional inverted index.

The index holds a posting (document, position) for each corpus word that the benchmark has.
The rarest terms of a benchmark window give the first lists of window starts (position less
the term's offset); lists are intersected, and what is left is checked against the postings
of the window's other terms. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import NO_ID, lower_ascii, own, rid, small, stage, text_hash

WINDOW = 13
#: How many lists, from the rarest term on, are intersected before the rest is checked.
FIRST_LISTS = 2
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
#: Fixed value: what words are not made of, once A-Z are lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The term of the posting at a document's end, whose position is the number of words.
_END = ""


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BETWEEN, -1), "")


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Postings (rid, th, pos, term) of the words that ``vocabulary(term)`` holds.

    Each row of ``docs`` also has a posting of the term '' after its last word. The table is
    written by the scan itself, without a shuffle.
    """
    terms = stage(
        vocabulary.select("term").distinct().union(
            docs.sparkSession.createDataFrame([(_END,)], "term string")
        ),
        "terms",
    )
    each = docs.select(
        rid().alias("rid"), text_hash().alias("th"),
        F.posexplode(F.array_append(words(F.col("text")), F.lit(_END))).alias("pos", "term"),
    )
    return stage(each.join(small(terms), "term").select("rid", "th", "pos", "term"), "postings")


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(w, words) of each distinct window, and (w, item_id) of the items that have it.

    A window is ``size`` consecutive words of an item; fewer words, but not none, are one
    window.
    """
    split = items.select("item_id", words(F.col("text")).alias("words")).where("size(words) > 0")
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))))
    each = split.select("item_id", "words", start.alias("start")).select(
        "item_id", F.slice("words", F.col("start"), F.lit(size)).alias("words")
    )
    windows = stage(
        each.groupBy("words").agg(F.collect_set("item_id").alias("items"))
        .withColumn("w", F.monotonically_increasing_id()),
        "windows",
    )
    return windows.select("w", "words"), windows.select("w", F.explode("items").alias("item_id"))


def _ranked_terms(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(w, n, off, term, rank): rank 1 is the window's rarest term in the corpus."""
    frequency = index.groupBy("term").agg(F.count("*").alias("df"))
    terms = windows.select("w", F.size("words").alias("n"), F.posexplode("words").alias("off", "term"))
    rank = F.row_number().over(Window.partitionBy("w").orderBy("df", "off"))
    return stage(
        terms.join(frequency, "term", "left")
        .withColumn("df", F.coalesce("df", F.lit(0))).withColumn("rank", rank),
        "window-terms",
    )


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(w, rid, th, start, n): every place where a document has a window's words in a row.

    Rows of the corpus that are equal share their matches. Windows of at most 62 words.
    """
    terms = _ranked_terms(index, windows)
    place = ["w", "rid", "th", "start"]
    seen = lambda name: F.expr(f"bit_count(bit_or(shiftleft(1L, {name})))")
    first = terms.where(F.col("rank") <= FIRST_LISTS).select("w", "n", "off", "term", "rank")
    lists = index.join(small(first), "term").select(
        "w", "rid", "th", (F.col("pos") - F.col("off")).alias("start"), "n", "rank"
    ).where("start >= 0")
    left = stage(
        lists.groupBy(*place).agg(F.first("n").alias("n"), seen("rank").alias("found"))
        .where(F.col("found") == F.least("n", F.lit(FIRST_LISTS))).drop("found"),
        "candidates",
    )
    # The other terms of what is left, looked up in the postings of its documents.
    documents = stage(left.select("rid", "th").distinct(), "candidate-documents")
    postings = index.join(small(documents), ["rid", "th"], "left_semi").distinct()
    rest = terms.where(F.col("rank") > FIRST_LISTS).select("w", "off", "term")
    wanted = left.join(rest, "w").select(
        *place, "n", "off", "term", (F.col("start") + F.col("off")).alias("pos")
    )
    checked = wanted.join(postings, ["rid", "th", "pos", "term"]).groupBy(*place).agg(
        F.first("n").alias("n"), seen("off").alias("found")
    ).where(F.col("found") == F.col("n") - FIRST_LISTS).drop("found")
    return left.where(F.col("n") <= FIRST_LISTS).unionByName(checked)


def proximity_matches(
    index: DataFrame, items: DataFrame, terms: int = 3, within: int = WINDOW
) -> DataFrame:
    """(item_id, rid, th, pos): places where an item's rarest terms stand close together.

    ``pos`` is the position of the rarest of up to ``terms`` different terms, with each of
    the others less than ``within`` words away. Terms that the corpus lacks match nothing.
    """
    frequency = index.groupBy("term").agg(F.count("*").alias("df"))
    each = items.select("item_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("df", "term"))
    ranked = (
        each.join(frequency, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        .withColumn("rank", rank).where(F.col("rank") <= terms)
    )
    ranked = stage(ranked, "item-terms")
    asked = ranked.groupBy("item_id").agg(F.count("*").alias("asked"))
    cell = F.floor(F.col("pos") / within)
    rarest = index.join(ranked.where("rank = 1").select("item_id", "term"), "term").select(
        "item_id", "rid", "th", F.col("pos").alias("at"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
    )
    others = index.join(ranked.where("rank > 1").select("item_id", "term", "rank"), "term").select(
        "item_id", "rid", "th", "pos", "rank", cell.alias("cell")
    )
    near = rarest.join(others, ["item_id", "rid", "th", "cell"]).where(
        F.abs(F.col("pos") - F.col("at")) < within
    )
    keys = ["item_id", "rid", "th", "at"]
    found = near.groupBy(*keys).agg(F.countDistinct("rank").alias("found"))
    alone = rarest.select(*keys).distinct().withColumn("found", F.lit(0).cast("long"))
    return (
        found.unionByName(alone).groupBy(*keys).agg(F.max("found").alias("found"))
        .join(asked, "item_id").where(F.col("found") == F.col("asked") - 1)
        .select("item_id", "rid", "th", F.col("at").alias("pos"))
    )


def find_contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: rid, th, n_words, n_hit, n_items, items, contaminated.

    Words are runs of letters and digits, A-Z lower-cased, other scripts' characters
    included; a NULL text has none. A word is hit if it lies inside an occurrence of any
    window of ``items(item_id, text)``; ``items`` lists the items with occurring windows, as
    sorted text. A row is contaminated if it has a hit and at least one in twenty words is
    hit. Equal rows get equal results. Items without words, NULL or empty, match nothing, and
    an item with a NULL id counts as the id ''. Empty tables are no exception.
    """
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    windows, of_item = benchmark_windows(items, size)
    index = build_index(docs, windows.select(F.explode("words").alias("term")))
    matches = stage(phrase_matches(index, windows), "matches")
    row = ["rid", "th"]
    inside = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1))
    hits = matches.select(*row, inside.alias("pos")).distinct().groupBy(*row).agg(
        F.count("*").alias("n_hit")
    )
    found = matches.select(*row, "w").distinct().join(of_item, "w").groupBy(*row).agg(
        F.sort_array(F.collect_set("item_id")).alias("items")
    )
    ends = index.where(F.col("term") == _END).select(*row, F.col("pos").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return ends.join(hits.join(found, row), row, "left").select(
        *row, "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    r, t = own(docs, "rid"), own(docs, "th")
    bad = find_contamination(docs, items, size).where("contaminated").select(
        F.col("rid").alias(r), F.col("th").alias(t)
    ).distinct()
    marked = docs.withColumns({r: rid(), t: text_hash()})
    return marked.join(small(stage(bad, "contaminated")), [r, t], "left_anti").select(
        *[f"`{c}`" for c in docs.columns]
    )


def op10_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    found = find_contamination(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
    )
    return found.select(
        F.when(F.col("rid") != F.lit(NO_ID), F.col("rid")).alias("doc_id"),
        "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (
  SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s
  FROM b WHERE len(words) > 0),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(words, s, s + 12), ' ') AS w,
    least(len(words), 13) AS n FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS s
  FROM d, sizes WHERE len(words) >= n),
m AS (
  SELECT doc_id, item_id, s, win.n FROM dw JOIN win
  ON win.n = dw.n AND win.w = array_to_string(list_slice(words, s, s + dw.n - 1), ' ')),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN item ON d.doc_id = item.doc_id
"""

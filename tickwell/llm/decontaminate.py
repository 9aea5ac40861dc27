"""Benchmark decontamination: which documents contain a test item.

Containment search over MinHash sketches, partitioned by size. A document that contains at least 0.8
of an item's n shingles lacks at most n // 5 of them, so it holds one of any n // 5 + 1. The sketch of
an item is that many smallest hashes, with n taken as the upper end of the item's size class: short
items get short sketches, and no pair is lost however long the document is. Documents whose hashes
meet a sketch are verified by exact containment of the shingles themselves. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.llm.common import SPACES, cut, table, text_of

SHINGLE = 5
#: Width of a size class, in shingles.
CLASS = 8
#: Sketch rows that are broadcast at most, about 16 bytes each; more are shuffled.
BROADCAST_ROWS = 1_000_000

BLANKS = " \t\n\v\f\r"


def words_of(column: str) -> Column:
    """Lower-cased words; an empty array for null, empty and blank texts."""
    trimmed = F.trim(F.lower(text_of(column)), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{SPACES}]+", -1)
    )


def shingles(words: str) -> Column:
    """All runs of five words; of fewer words the whole run, of none nothing."""
    size = F.size(words)
    several = F.transform(
        F.sequence(F.lit(0), size - SHINGLE),
        lambda at: F.concat_ws(" ", *[F.get(words, at + k) for k in range(SHINGLE)]),
    )
    short = F.array(F.array_join(words, " "))
    return (
        F.when(size >= SHINGLE, several)
        .when(size > 0, short)
        .otherwise(F.array().cast("array<string>"))
    )


def hashes(words: str) -> Column:
    """One hash for each run of words, without making its text."""
    size = F.size(words)
    several = F.transform(
        F.sequence(F.lit(0), size - SHINGLE),
        lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(SHINGLE)]),
    )
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return (
        F.when(size >= SHINGLE, several)
        .when(size > 0, short)
        .otherwise(F.array().cast("array<bigint>"))
    )


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, shingles, sketch) for each distinct item with words."""
    words = benchmark.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    made = words.distinct().select(
        "item_id",
        F.array_distinct(shingles("words")).alias("shingles"),
        F.array_sort(F.array_distinct(hashes("words"))).alias("hashes"),
    )
    upper = F.ceil(F.size("shingles") / CLASS) * CLASS
    length = F.least(F.floor(upper / 5) + 1, F.size("hashes")).cast("int")
    return made.select("item_id", "shingles", F.slice("hashes", F.lit(1), length).alias("sketch"))


def verified(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, part, item_id, n_shingles, n_shared): pairs with 0.8 or more, `part` the text's hash."""
    items = cut(items_of(benchmark)).withColumn("item_part", F.monotonically_increasing_id())
    items = cut(items)
    sketches = items.select("item_part", F.explode("sketch").alias("hash"))
    if sketches.count() <= BROADCAST_ROWS:
        sketches = F.broadcast(sketches)
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("part", F.xxhash64("text"))
    runs = rows.select("doc_id", "part", words_of("text").alias("words"))
    exploded = runs.select("doc_id", "part", F.explode(hashes("words")).alias("hash"))
    met = cut(exploded.join(sketches, "hash").select("doc_id", "part", "item_part").distinct())

    candidates = met.select(F.col("doc_id").alias("met_id"), F.col("part").alias("met_part"), "item_part")
    same = F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("part") == F.col("met_part"))
    texts = rows.join(candidates, same).select("doc_id", "part", "item_part", words_of("text").alias("words"))
    pairs = texts.join(items.select("item_part", "item_id", "shingles"), "item_part")
    counted = pairs.select(
        "doc_id",
        "part",
        "item_id",
        F.size("shingles").cast("long").alias("n_shingles"),
        F.size(F.array_intersect("shingles", shingles("words"))).cast("long").alias("n_shared"),
    )
    return counted.where("5 * n_shared >= 4 * n_shingles")


def contained(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared): items of which a document holds 0.8 or more.

    One row for each pair. Items and documents without words take part in no pair; an item of fewer
    than five words is found only in a document of exactly these words. Repeated rows give one pair;
    where rows share a doc_id, or an item_id, the pair with the most shared shingles counts. Documents
    without a doc_id are reported under null. Texts are searched whole. A sketch is one hash for about
    five words of an item; up to a set number of them is broadcast, more are shuffled.
    """
    enough = verified(docs, benchmark)
    best = F.max_by(F.struct("n_shingles", "n_shared"), F.struct(F.col("n_shared") / F.col("n_shingles"), "n_shared"))
    return enough.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item, with the columns they came with.

    Rows without a doc_id are told apart by their text, as are rows that share a doc_id.
    """
    pairs = verified(docs, benchmark)
    bad = pairs.select(F.col("doc_id").alias("bad_id"), F.col("part").alias("bad_part")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64(text_of()) == F.col("bad_part"))
    return docs.join(bad, same, "left_anti")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), d AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS s
  FROM w
), v AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM benchmark
), b AS (
  SELECT item_id, list_distinct(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS ss
  FROM v
), i AS (SELECT item_id, len(ss) AS n_shingles, unnest(ss) AS s FROM b)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
FROM d JOIN i USING (s) GROUP BY ALL HAVING 5 * count(*) >= 4 * n_shingles
"""

"""Benchmark decontamination (operator 3), with DataFrame functions only.

A test item leaks into a document that holds at least `percent` of the item's
distinct 5-word shingles. Items are tiny beside long documents, so plain MinHash
similarity says nothing; containment search is made exact instead:

1. Items are partitioned by size (powers of two). The MinHash sketch of an item is
   its s least shingle hashes, with s of its partition: one more than the number of
   shingles that the largest item of the partition may miss. A document that contains
   an item therefore holds at least one value of its sketch: no candidate is lost.
2. Documents stream their shingle hashes against the sketches (candidates).
3. Candidates are verified by the shingles themselves, as text.

An item of fewer than 5 words counts as one shingle of all its words. Words are maximal
runs without white space, lower-cased. The item side is broadcast only while Spark's own size
estimate is below its threshold (spark.sql.autoBroadcastJoinThreshold); beyond it the joins shuffle.

Defined results: null or empty texts and items match nothing; null doc_ids are ignored; rows repeating a
doc_id are one document; repeated item_ids are one item (their shingles together); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplecast.llm.tables import materialise, read

WORD = r"[^\x20\x09-\x0D]+"
K = 5
PERCENT = 80


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(words: Column, k: int, make) -> Column:
    """make(k words) at every place; no place in shorter texts."""
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: make(*(F.get(words, i + j) for j in range(k))))


def _hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def _text(*words: Column) -> Column:
    return F.concat_ws(" ", *words)


def item_shingles(items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, width, shingle, hash, n_item): the distinct shingles of every item."""
    w = F.col("words")
    words = items.where("item_id IS NOT NULL").select("item_id", _words(F.col("text")).alias("words")).where(F.size(w) > 0)
    parts = []
    for width in range(1, k + 1):
        some = words.where(F.size(w) >= k if width == k else F.size(w) == width)
        both = _shingles(w, width, lambda *x: F.struct(_text(*x).alias("shingle"), _hash(*x).alias("hash")))
        parts.append(some.select("item_id", F.lit(width).alias("width"), F.explode(both).alias("x")))
    all_of = parts[0]
    for p in parts[1:]:
        all_of = all_of.unionByName(p)
    distinct = all_of.select("item_id", "width", "x.shingle", "x.hash").distinct()
    size = distinct.groupBy("item_id").agg(F.count("*").alias("n_item"))
    return distinct.join(size, "item_id")


def sketches(shingles: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(width, hash, item_id): the s least hashes of every item, s by its size partition."""
    part = F.floor(F.log2("n_item"))
    largest = F.pow(F.lit(2), part + 1).cast("long") - 1
    least = F.floor(largest * (100 - percent) / 100) + 1
    ordered = shingles.groupBy("item_id", "n_item").agg(F.sort_array(F.collect_set(F.struct("hash", "width"))).alias("all"))
    kept = ordered.select("item_id", F.explode(F.slice("all", F.lit(1), least.cast("int"))).alias("x"))
    return kept.select("x.width", "x.hash", "item_id")


def find_leaks(
    docs: DataFrame, items: DataFrame, percent: int = PERCENT, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) with 100 * n_shared >= percent * n_item."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    items = materialise(item_shingles(items.select("item_id", "text"), k), "decontamination-items")
    sketch = materialise(sketches(items, percent), "decontamination-sketches")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most k numbers
    w = F.col("words")
    words = docs.select("doc_id", _words(F.col("text")).alias("words"))
    found = docs.select("doc_id").limit(0).withColumn("item_id", F.lit(None).cast("long"))
    for width in widths:
        streamed = words.select("doc_id", F.explode(_shingles(w, width, _hash)).alias("hash"))
        mine = sketch.where(F.col("width") == width).select("hash", "item_id")
        found = found.unionByName(streamed.join(mine, "hash").select("doc_id", "item_id"))
    candidates = materialise(found.distinct(), "decontamination-candidates")

    # Verification: the candidates' documents once more, by the shingles as text.
    suspects = docs.join(candidates.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    words = suspects.select("doc_id", _words(F.col("text")).alias("words"))
    parts = None
    for width in widths:
        held = words.select("doc_id", F.explode(F.array_distinct(_shingles(w, width, _text))).alias("shingle"))
        mine = items.where(F.col("width") == width).select("shingle", "item_id", "n_item")
        part = held.join(mine, "shingle")
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return candidates.select("doc_id", "item_id", F.lit(0).cast("long").alias("n_item"), F.lit(0).cast("long").alias("n_shared"))
    shared = parts.distinct().groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared"))
    return (
        shared.join(candidates, ["doc_id", "item_id"])
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        .select("doc_id", "item_id", "n_item", "n_shared")
    )


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that hold no test item (null ids stay)."""
    leaks = find_leaks(docs, items, id_col=id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(leaks.hint("shuffle_hash"), id_col, "left_anti")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL
), i AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), s AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS width,
         unnest([array_to_string(w[p:p + least(5, len(w)) - 1], ' ') FOR p IN range(1, len(w) - least(5, len(w)) + 2)]) AS shingle
  FROM i WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
h AS (
  SELECT DISTINCT doc_id, width,
         unnest([array_to_string(w[p:p + width - 1], ' ') FOR p IN range(1, len(w) - width + 2)]) AS shingle
  FROM d, (SELECT DISTINCT width FROM s) WHERE len(w) >= width
)
SELECT doc_id, item_id, n_item, count(*) AS n_shared
FROM h JOIN s USING (width, shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item
HAVING 100 * count(*) >= 80 * n_item
"""

"""Benchmark decontamination: containment search with size-partitioned MinHash sketches.

A test item of ``n`` distinct five-word shingles is contained in a document when at least 80 %
of them occur there. Items are partitioned by size (powers of two). An item's sketch is its
``u - ceil(0.8 u) + 1`` smallest shingle hashes, ``u`` the largest size in its partition: a
document that contains the item misses too few shingles to miss the whole sketch, so no match
is lost. On the document side only shingles under the highest sketch hash of a partition are
looked up. Candidates are verified by exact containment on the shingles themselves.

Words are runs of characters other than space and 0x09 to 0x0D, lower-cased.

* null text and text without words have no shingles, match nothing and are clean
* fewer words than a shingle: the whole sequence is the one shingle
* null ids take part; rows that repeat are judged each; other columns are ignored or kept
* no items, or no documents: no matches

All of it is DataFrame expressions. The sketch index is stored first, so that Spark broadcasts
it by its real size if it is under the session's threshold, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from galley.llm.common import Stage, boxed

WORDS = 5
PERCENT = 80

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), _SPACE), "")


def _per_shingle(words: str, expression: str) -> Column:
    """``expression`` of the first word's place ``i`` for every shingle; a short text is one shingle."""
    last = f"size({words}) - {WORDS}"
    return F.expr(
        f"array_distinct(transform(if(size({words}) = 0, array(), sequence(0, greatest({last}, 0))), i -> {expression}))"
    )


def _hashes(words: str) -> Column:
    parts = ", ".join(f"get({words}, i + {k})" for k in range(WORDS))
    return _per_shingle(words, f"xxhash64({parts})")


def _texts(words: str) -> Column:
    return _per_shingle(words, f"array_join(slice({words}, i + 1, {WORDS}), ' ')")


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def sketches(items: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """``hash, row, partition`` of every sketch, and ``row, item_id, shingles`` of every item."""
    rows = items.select("item_id", _words("text").alias("words")).filter("size(words) > 0")
    rows = rows.withColumn("shingles", _texts("words")).withColumn("row", F.xxhash64("item_id", "words")).dropDuplicates(["item_id", "row"])
    whole = stage.save(rows.select("row", "item_id", "shingles", F.array_sort(_hashes("words")).alias("hashes")), "items")
    sized = whole.withColumn("partition", F.floor(F.log2(F.size("hashes"))).cast("int"))
    largest = sized.groupBy("partition").agg(F.max(F.size("hashes")).alias("u"))
    length = F.col("u") - F.floor((F.lit(PERCENT) * F.col("u") + 99) / 100) + 1
    index = sized.join(largest, "partition").select(
        "row", "partition", F.explode(F.slice("hashes", F.lit(1), length.cast("int"))).alias("hash")
    )
    return stage.save(index, "index"), whole.select("row", "item_id", "shingles")


def matches(docs: DataFrame, items: DataFrame, stage: Stage | None = None) -> DataFrame:
    """``doc_id, text_key, item_id, n_shingles, n_shared`` for every contained item of every row of ``docs``."""
    stage = stage or Stage(docs.sparkSession, "containment")
    index, whole = sketches(items, stage)
    # One number per partition: 64 rows at most.
    ceilings = [r["top"] for r in index.groupBy("partition").agg(F.max("hash").alias("top")).collect()]
    top = max(ceilings, default=-(1 << 63))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = (
        rows.select("doc_id", _text_key().alias("text_key"), _words("text").alias("words"))
        .select("doc_id", "text_key", F.filter(_hashes("words"), lambda h: h <= F.lit(top)).alias("hashes"))
        # explode_outer: for explode the optimizer would test for empty arrays first, far below, by
        # the whole expression once more. The null of an empty array joins nothing.
        .select("doc_id", "text_key", F.explode_outer("hashes").alias("hash"))
        .join(index.select("hash", "row"), "hash")
        .select("doc_id", "text_key", "row").distinct()
    )
    found = stage.save(found, "candidates").withColumnsRenamed({"doc_id": "id_", "text_key": "key_"})
    rows = rows.withColumn("text_key", _text_key())
    checked = (
        rows.join(found, rows["doc_id"].eqNullSafe(found["id_"]) & (rows["text_key"] == found["key_"]))
        .join(whole, "row")
        .withColumn("words", _words("text"))
        .select(
            "doc_id", "text_key", "item_id", F.size("shingles").cast("long").alias("n_shingles"),
            F.size(F.array_intersect(_texts("words"), "shingles")).cast("long").alias("n_shared"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    # With a column that is not deterministic the condition stays above the shingles. Pushed below,
    # it would split the text again for every shingle.
    return checked.filter((100 * F.col("n_shared") >= PERCENT * F.col("n_shingles")) & (F.col("place") >= 0)).drop("place")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    stage = Stage(docs.sparkSession, "containment")
    leaks = stage.save(matches(docs, items, stage).select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_")).distinct(), "leaks")
    rows = boxed(docs)
    same = rows["doc_id"].eqNullSafe(leaks["id_"]) & (_text_key() == leaks["key_"])
    return rows.join(leaks, same, "left_anti").select("row.*")

"""Kept word statistics: in how many items a word occurs, and how many items there are.

A batch changes them by deltas alone: the words of an item's stored version are taken off, those of
its new version are added. So scores do not depend on how the items came in batches.

Four tables, wherever ``place`` puts them: ``item_terms`` has the words of each item as counted,
``word_stats`` the count of each word (the empty word counts items). ``word_delta`` and ``word_items``
hold one batch between being worked out and being applied. A row of ``word_stats`` remembers the
batch it was last changed by and its count before, so a batch that is applied again after a failure
changes nothing; ``settle`` finishes a batch that was left behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from galley.functions.literals import empty_rows
from galley.operators.joins import sized
from galley.schemas import WORD_DELTA, WORD_STATS
from galley.session import materialize
from galley.sources.tables import read_table, replace_table, table_exists, upsert

ALL_ITEMS = ""  # no word is empty
_SLOTS = 16

Place = Callable[[str], str]


def _read(spark: SparkSession, place: Place, name: str, schema) -> DataFrame:
    where = place(name)
    return read_table(spark, where, schema) if table_exists(spark, where) else empty_rows(spark, schema)


def _changes(items: DataFrame, sign: int) -> DataFrame:
    """One row for each word of each item, and one for the item itself."""
    words = F.array_append("terms", F.lit(ALL_ITEMS))
    return items.select(F.explode(words).alias("term"), F.lit(sign).cast("long").alias("delta"))


def learn(terms: DataFrame, docs: DataFrame, key: Sequence[str], place: Place) -> None:
    """Bring the statistics up to a batch. ``docs`` has the key of every item, ``terms`` their counted words.

    Keys must be unique in ``docs``; items with a NULL in the key are left out, as from any upsert.
    """
    spark = docs.sparkSession
    settle(spark, key, place)
    present = docs.select(*key).dropna()
    words = terms.groupBy(*key).agg(F.sort_array(F.collect_set("term")).alias("terms"))  # bounded by one text
    batch = F.lit(uuid.uuid4().hex)
    items = present.join(words, list(key), "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    items = materialize(items, "item_terms")
    stored = _read(spark, place, "item_terms", items.schema)
    old = stored.join(sized(items.select(*key)), list(key), "left_semi")
    delta = _changes(items, 1).unionAll(_changes(old, -1)).groupBy("term").agg(F.sum("delta").alias("delta"))
    replace_table(items.withColumn("batch", batch), place("word_items"))
    # From here on the batch is complete and will be applied, now or by the next run.
    replace_table(delta.filter("delta <> 0").withColumn("batch", batch), place("word_delta"))
    settle(spark, key, place)


def settle(spark: SparkSession, key: Sequence[str], place: Place) -> bool:
    """Apply the batch that waits, if there is one."""
    if not table_exists(spark, place("word_items")):
        return False
    delta = _read(spark, place, "word_delta", WORD_DELTA)
    items = read_table(spark, place("word_items"))
    waiting = items.select("batch").limit(1).collect()
    if not waiting:
        return False
    delta = delta.filter(F.col("batch") == F.lit(waiting[0]["batch"]))
    slot = F.pmod(F.xxhash64("term"), F.lit(_SLOTS)).cast("string")
    changed = delta.select(slot.alias("slot"), "term", "delta", F.col("batch").alias("now"))
    known = changed.join(_read(spark, place, "word_stats", WORD_STATS), ["slot", "term"], "left")
    base = F.when(F.col("batch") == F.col("now"), F.col("before")).otherwise(F.coalesce("df", F.lit(0)))
    after = known.select("slot", "term", (base + F.col("delta")).alias("df"), base.alias("before"), F.col("now").alias("batch"))
    if not delta.isEmpty():
        upsert(materialize(after, "word_stats"), place("word_stats"), ("slot", "term"), ("slot",), check_unique=False, staged=True)
        upsert(items.drop("batch"), place("item_terms"), key, check_unique=False)
    replace_table(items.limit(0), place("word_items"))
    return True


def stats(spark: SparkSession, place: Place) -> DataFrame:
    """``term, df`` of every word; under the empty word the number of items."""
    return _read(spark, place, "word_stats", WORD_STATS).select("term", "df")

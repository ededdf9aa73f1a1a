"""A global shuffle of records in two passes, cut into shards of equal row counts.

Pass 1 scatters records into buckets of bounded size by a seeded hash of id and text. Pass 2
holds one bucket at a time, puts it into random order by Fisher-Yates with a generator seeded
by the bucket, and writes it. The shuffled order is bucket after bucket; shard ``s`` of ``S``
takes the places from ``s*N//S`` up to ``(s+1)*N//S``, so counts differ by one at most.

A bucket is sorted before it is permuted, so a task that runs again writes the same rows. Each bucket
is a task of its own. Rows that are equal throughout, more than ``COPIES`` of them, are counted,
numbered and dealt by their numbers, so they do not meet in one bucket.

* null text has no bytes: size 8, checksum 0; null ids are spread by their text
* equal rows each get a slot; up to ``COPIES`` of them share a bucket
* an empty table gives no rows; other columns are ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from galley.llm.common import map_batches

BUCKET_BYTES = 32 << 20
COPIES = 1000
_BROADCAST_ROWS = 100_000  # bucket list, or list of rows with many copies; 16 bytes a row


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text) with ``copy``: 0, or from 1 on for rows of which there are more than ``COPIES``."""
    key = F.xxhash64("doc_id", "text").alias("key")
    many = rows.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > COPIES).select("key")
    held = many.limit(_BROADCAST_ROWS + 1).count()
    if not held:
        return rows.withColumn("copy", F.lit(0))
    many = F.broadcast(many) if held <= _BROADCAST_ROWS else many
    keyed = rows.withColumn("key", key)
    few = keyed.join(many, "key", "left_anti").select("doc_id", "text", F.lit(0).alias("copy"))
    counted = keyed.join(many, "key", "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("n"))
    # In two steps: the numbers of one row may be a third of all rows, too many to be made by one task.
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("int"))))
    parts = parts.repartition("part", "doc_id", "text")
    first, last = F.col("part") * COPIES + 1, F.least((F.col("part") + 1) * COPIES, F.col("n").cast("int"))
    return few.unionAll(parts.select("doc_id", "text", F.explode(F.sequence(first, last)).alias("copy")))


def write_shuffled(docs: DataFrame, path: str, shards: int, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``docs`` (doc_id, text) under ``path`` as Parquet folders ``shard=0`` and so on, in slot order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    total = rows.agg(F.sum(size).alias("b"), F.count("*").alias("n")).first()
    count, buckets = total["n"], max(1, -(-(total["b"] or 0) // bucket_bytes))

    rows = _numbered(rows)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text", "copy"), F.lit(buckets)).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket: a list that is small beside the data by the size of a bucket.
    bases = rows.groupBy("bucket").count().select(
        "bucket", F.coalesce(F.sum("count").over(before), F.lit(0).cast("long")).alias("base")
    )
    rows = rows.join(F.broadcast(bases) if buckets <= _BROADCAST_ROWS else bases, "bucket")

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shuffled(held: list[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            order = np.arange(whole.num_rows)
            np.random.Generator(np.random.Philox(key=[seed, bucket])).shuffle(order)  # Fisher-Yates
            places = whole.column("base")[0].as_py() + np.arange(whole.num_rows, dtype=np.int64)
            for at in range(0, len(order), 1024):
                part = whole.take(order[at : at + 1024])
                where = places[at : at + 1024]
                shard = ((where + 1) * shards - 1) // max(count, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").combine_chunks(), part.column("text").combine_chunks(),
                     pa.array(shard.astype(np.int32)), pa.array(where - shard * count // shards)],
                    ["doc_id", "text", "shard", "slot"],
                )

        held, current = [], None
        for batch in batches:
            ids = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and ids[a] != current:
                    yield from shuffled(held, int(current))
                    held = []
                current = ids[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from shuffled(held, int(current))

    dealt = (
        rows.select("bucket", "base", "doc_id", "text")
        .repartitionById(int(buckets), "bucket")
        .sortWithinPartitions("bucket", "doc_id", "text")
    )
    (
        map_batches(dealt, permute, "doc_id long, text string, shard int, slot long")
        .sortWithinPartitions("shard", "slot")
        .write.option("compression", "zstd").partitionBy("shard").parquet(path)
    )


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of shuffled records read back."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

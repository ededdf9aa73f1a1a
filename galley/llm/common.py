"""Shared helpers: reading the tables, staging intermediate results, streaming rows through tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galley.session import scratch_path
from galley.sources import files

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@contextmanager
def _shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a finished write are deleted at once instead of when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Stage:
    """Intermediate tables of one operator, written to the shared folder and read back.

    A written table survives lost executors and cuts the lineage. ``free`` deletes what
    later steps no longer read.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        with _shuffle_files_freed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self, *names: str) -> None:
        for name in names or list(self.paths):
            files.delete(self.spark, self.paths.pop(name))


def splittable(keys: DataFrame) -> DataFrame:
    """Rows of an aggregate, spread anew before a join on their key.

    Joined as it is, the aggregate's own shuffle would serve the join too, and then Spark cannot
    split a hot key of the other side over several tasks.
    """
    return keys.hint("rebalance")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a text column as bytes; null counts as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns an operator works on, so that other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` (integers) of a partition sorted by them, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def boxed(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: all columns in one struct, so that none can clash with a helper column.

    ``select("row.*")`` gives the documents back.
    """
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )

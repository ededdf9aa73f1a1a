"""Joining a big frame to a dimension whose size is measured, not assumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from galley.session import materialize

# A broadcast side is copied to every executor; past this many bytes the join shuffles.
BROADCAST_BYTES = 64 * 1024 * 1024


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def byte_setting(spark: SparkSession, key: str, default: str) -> int:
    """A size setting in bytes: a number, or one with a unit such as ``10m`` or ``64KB``."""
    text = spark.conf.get(key, default).strip().lower()
    number = text.rstrip("bkmgtp")
    unit = text[len(number) :]
    return int(number) * _UNITS[unit[:1]]


def text_bytes(df: DataFrame) -> int:
    """Size of the rows written out as JSON text: one distributed pass, one number back."""
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("long"))
    return df.agg(F.coalesce(size, F.lit(0)).alias("bytes")).first()["bytes"]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own estimate; a frame it knows nothing about comes out enormous."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def sized(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring that it fits under ``limit``.

    Spark already broadcasts by itself what it estimates under its own threshold, so that is
    left alone; a threshold of -1 forbids broadcasts, here too. Anything else is computed once,
    stored, and measured there. A frame larger than ``limit`` is returned unmarked: the join then
    shuffles on its key, and AQE splits a key that holds too many rows.
    """
    threshold = byte_setting(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold", "10485760")
    if threshold < 0 or estimated_bytes(df) <= threshold:
        return df
    stored = materialize(df, "dimension")
    return F.broadcast(stored) if text_bytes(stored) <= limit else stored


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Equi-join that keeps the fact side where it is whenever the dimension fits."""
    return facts.join(sized(dimension, limit), on, how)

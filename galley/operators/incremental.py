"""What is new: high-water marks and date bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from galley.operators.joins import sized
from galley.session import materialize


def high_water_marks(stored: DataFrame, group: str = "content_type") -> DataFrame:
    """Latest publication and update time per content type: one row per type."""
    return stored.groupBy(group).agg(
        F.max("published_at").alias("max_published_at"), F.max("updated_at").alias("max_updated_at")
    )


def after_marks(incoming: DataFrame, marks: DataFrame, group: str = "content_type") -> DataFrame:
    """Items updated at or after their type's mark; a type with no mark is taken whole.

    An item as old as the mark may still be unseen, and taking it again is harmless, as the
    upsert repeats nothing. An item without an update time is held against the publication
    mark; without either time it is taken. The marks are staged and measured first, so the
    incoming side is not shuffled onto a handful of type values.
    """
    mark = F.struct("max_updated_at", "max_published_at").alias("_mark")
    marks = materialize(marks.select(F.col(group).alias("_group"), mark), "marks")

    def reached(item: str) -> Column:
        limit = F.col(f"_mark.max_{item}")
        return limit.isNull() | (F.col(item) >= limit)

    published = F.col("published_at").isNull() | reached("published_at")
    new = F.when(F.col("updated_at").isNotNull(), reached("updated_at")).otherwise(published)
    known = incoming.join(sized(marks), F.col(group) == F.col("_group"), "left")
    return known.filter(F.col("_mark").isNull() | new).select(*incoming.columns)


def within_dates(
    df: DataFrame, published_from=None, published_to=None, updated_from=None
) -> DataFrame:
    """Inclusive bounds on publication and update time; an absent bound is open."""
    if published_from is not None:
        df = df.filter(F.col("published_at") >= F.lit(published_from))
    if published_to is not None:
        df = df.filter(F.col("published_at") <= F.lit(published_to))
    if updated_from is not None:
        df = df.filter(F.col("updated_at") >= F.lit(updated_from))
    return df

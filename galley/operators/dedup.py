"""One row per key: newest, first seen, or any-but-always-the-same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from galley.functions.text import version_key


def sortable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    """Columns usable as tie-breakers, in name order."""
    unordered = (T.MapType, T.VariantType, T.CalendarIntervalType)

    def orderable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return orderable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(orderable(f.dataType) for f in kind.fields)
        return not isinstance(kind, unordered)

    return sorted(f.name for f in df.schema.fields if f.name not in skip and orderable(f.dataType))


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key under ``order``, numbered from 1 in ``rank`` if it is named.

    Up to ``windowGroupLimitThreshold`` rows Spark limits each map task to ``n`` rows per key
    before the shuffle, so a key holding a large share of the table arrives as a handful.
    """
    place = rank or "_place"
    placed = df.select("*", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias(place))
    first = placed.filter(F.col(place) <= n)
    return first if rank else first.select(*df.columns)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("content_type", "id"),
    order_by: str = "updated_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Newest version of each key; a NULL ``order_by`` loses to any value.

    Without that column the survivor is picked by the remaining columns, so a re-run
    picks the same row.
    """
    ties = list(ties) if ties is not None else sortable(df, [*keys, order_by])
    order = [F.col(c).desc_nulls_last() for c in ([order_by] if order_by in df.columns else []) + ties]
    return top_n_per_key(df, keys, order or [F.lit(1)])


def first_per_key(
    df: DataFrame, keys: Sequence[str] = ("content_type", "id"), arrival: Sequence[str] = ("arrival",)
) -> DataFrame:
    """First-seen row of each key, arrival order being explicit columns."""
    return top_n_per_key(df, keys, [F.col(c).asc_nulls_last() for c in arrival])


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """dropDuplicates on ``keys`` with a reproducible survivor."""
    return top_n_per_key(df, keys, [F.col(c).asc_nulls_last() for c in sortable(df, keys)] or [F.lit(1)])


def highest_version_per_key(df: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """One row per key, the one with the highest version number; other columns come along.

    A plain aggregate: rows are reduced on the map side before anything is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(version_key(version).alias("v"), F.col(version).alias("t"), *sortable(df, [*keys, version]))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])

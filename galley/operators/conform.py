"""Bringing frames to a declared shape, and stacking frames of differing shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from galley.functions.dates import on_date, parse_run_date


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones are typed NULLs."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column one frame lacks is NULL for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_content(
    parts: dict[str, DataFrame],
    published_date: str | None = None,
    required: tuple[str, ...] = ("news_site",),
) -> DataFrame:
    """Stack the per-type tables, stamping each row with the type of its table.

    ``published_date`` keeps one publication day; the filter is on partition columns and
    sits on each branch, so only that day's files are read.
    """
    day = parse_run_date(published_date)
    frames = []
    for content_type, df in parts.items():
        if day:
            df = df.filter(on_date(day))
        df = df.withColumn("content_type", F.lit(content_type))
        missing = {c: F.lit(None).cast("string") for c in required if c not in df.columns}
        frames.append(df.withColumns(missing) if missing else df)
    return union_all(frames)


def split_by_value(df: DataFrame, column: str, tables: dict[str, str]) -> dict[str, DataFrame]:
    """One filtered frame per value, keyed by table name. Persist ``df`` first if it is costly."""
    return {table: df.filter(F.col(column) == value) for value, table in tables.items()}

"""Dates: run-date arguments, timestamp parsing, zero-padded date parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from galley.schemas import DATE_PARTS


def parse_run_date(value: str | dt.date | None) -> tuple[str, str, str] | None:
    """``YYYY-MM-DD`` (or a date) to zero-padded (year, month, day); other text raises."""
    if value is None:
        return None
    if isinstance(value, str):
        value = dt.datetime.strptime(value, "%Y-%m-%d")
    return f"{value.year:04d}", f"{value.month:02d}", f"{value.day:02d}"


def parse_timestamp(column: str | Column) -> Column:
    """ISO-8601 text, with or without fractional seconds, to a timestamp; bad text to NULL."""
    return F.try_to_timestamp(F.col(column) if isinstance(column, str) else column)


def _padded(part: Column, width: int) -> Column:
    return F.lpad(part.cast("string"), width, "0")


def with_date_parts(
    df: DataFrame,
    source: str | tuple[str, str, str] | dt.date,
    names: tuple[str, str, str] = DATE_PARTS,
) -> DataFrame:
    """Add three text columns: from a date/timestamp column, or constants from a run date.

    A string ``source`` names a column; a tuple or date is a constant for every row.
    """
    if isinstance(source, str):
        column = F.col(source)
        parts = (_padded(F.year(column), 4), _padded(F.month(column), 2), _padded(F.day(column), 2))
    else:
        constant = source if isinstance(source, tuple) else parse_run_date(source)
        parts = tuple(F.lit(text) for text in constant)
    return df.withColumns(dict(zip(names, parts)))


def with_text_date_parts(df: DataFrame, column: str, names: tuple[str, str, str] = DATE_PARTS) -> DataFrame:
    """The same three columns cut out of ISO text, for layers that keep dates as text."""
    text = F.col(column)
    cuts = (F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2))
    return df.withColumns(dict(zip(names, cuts)))


def on_date(year_month_day: tuple[str, str, str], names: tuple[str, str, str] = DATE_PARTS) -> Column:
    """Partition predicate for one date; Spark turns it into PartitionFilters."""
    year, month, day = (F.col(n) == F.lit(v) for n, v in zip(names, year_month_day))
    return year & month & day

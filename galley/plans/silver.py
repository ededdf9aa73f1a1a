"""Raw to cleaned: newest version of each item, one table per type, and the site list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from galley.functions.dates import parse_run_date, with_date_parts
from galley.functions.text import blank_to_null, not_blank, parse_records
from galley.operators.conform import conform
from galley.operators.dedup import highest_version_per_key, latest_per_key
from galley.operators.quality import normalise
from galley.schemas import CONTENT_KEY, DATE_PARTS, INGESTION_PARTS, ITEM, SILVER_INFO

# Columns of an item that hold lists of records.
NESTED = ("authors", "launches", "events")


def clean_content(bronze: DataFrame) -> DataFrame:
    """Newest version per (type, id), its dates parsed, its texts trimmed, its date parts set.

    Times are parsed before they are compared: as text, ``...23Z`` sorts after ``...23.6Z``.
    """
    parsed = normalise(bronze, ("title", "news_site"), ("published_at", "updated_at"))
    return with_date_parts(latest_per_key(parsed, CONTENT_KEY), "published_at")


def stamp_ingestion(df: DataFrame, ingestion_date) -> DataFrame:
    """Constant columns naming the run that loaded the rows."""
    return with_date_parts(df, parse_run_date(ingestion_date), INGESTION_PARTS)


def explode_sites(info: DataFrame) -> DataFrame:
    """One row per official site, trimmed. An empty, blank or unreadable list gives no row.

    ``news_sites`` may be a native array or list text.
    """
    return info.withColumn("news_site", F.explode(_sites(info))).drop("news_sites").withColumn(
        "news_site", blank_to_null("news_site")
    )


def _sites(info: DataFrame) -> Column:
    listed = isinstance(info.schema["news_sites"].dataType, T.StringType)
    return parse_records("news_sites", "array<string>") if listed else F.col("news_sites")


def unreadable_sites(info: DataFrame) -> DataFrame:
    """Info rows whose list holds something but cannot be read; ``explode_sites`` has no rows for them."""
    if not isinstance(info.schema["news_sites"].dataType, T.StringType):
        return info.limit(0)
    return info.filter(not_blank("news_sites") & _sites(info).isNull())


def clean_info(bronze_info: DataFrame, ingestion_date) -> DataFrame:
    """Sites of one run, dated by ingestion, one row per site and day (highest version)."""
    dated = with_date_parts(explode_sites(bronze_info), parse_run_date(ingestion_date))
    dated = conform(dated, SILVER_INFO)
    return highest_version_per_key(dated, ["news_site", *DATE_PARTS])


def with_native_lists(items: DataFrame) -> DataFrame:
    """A raw layer that stores nested columns as list text, brought to native arrays."""
    texts = {c for c, kind in items.dtypes if kind == "string"}
    return items.withColumns({c: parse_records(c, ITEM[c].dataType.simpleString()) for c in NESTED if c in texts})


def explode_launches(items: DataFrame) -> DataFrame:
    """One row per launch; an item without launches keeps a row."""
    return _one_each(items, "launches", {"launch_id": "launch_id", "provider": "launch_provider"})


def explode_events(items: DataFrame) -> DataFrame:
    """One row per event; an item without events keeps a row."""
    return _one_each(items, "events", {"event_id": "event_id", "provider": "event_provider"})


def _one_each(items: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    one = items.withColumn("_one", F.explode_outer(column)).drop(column)
    return one.select("*", *[F.col(f"_one.{f}").alias(name) for f, name in fields.items()]).drop("_one")


def explode_authors(items: DataFrame) -> DataFrame:
    """One row per author with the account names flattened; an item without authors keeps a row."""
    return items.withColumn("author", F.explode_outer("authors")).drop("authors").select(
        "*", F.col("author.name").alias("author_name"), F.col("author.socials").alias("_socials")
    ).select("*", "_socials.*").drop("author", "_socials")

"""Trend and ranking marts over the star schema.

Facts are counted on their own columns before a dimension is joined, so what is shuffled
is one row per source (or type) and period, not one row per article. Rankings end in the
key columns, so equal counts have one order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from galley.operators.joins import join_dimension

MONTH = ("year", "month")
DAY = ("year", "month", "day")


def _count(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows by group; of changes (with a column ``change``) what the counts gain or lose."""
    n = F.sum("change") if "change" in df.columns else F.count("*")
    return df.groupBy(*by).agg(n.alias("article_count"))


def with_changes(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored counts with what they gain or lose (in the same columns); groups left without rows go."""
    by = [c for c in stored.columns if c != "article_count"]
    both = stored.unionByName(changes.select(*stored.columns))
    return both.groupBy(*by).agg(F.sum("article_count").alias("article_count")).filter("article_count <> 0")


def by_month(fact: DataFrame) -> DataFrame:
    """Items per month."""
    return _count(fact, MONTH)


def by_source_period(fact: DataFrame, source_dim: DataFrame, period: Sequence[str] = MONTH) -> DataFrame:
    """Items per source and period. Items without a known source form the NULL group."""
    counted = _count(fact, ("news_source_id", *period))
    named = counted.join(source_dim.select("news_source_id", "news_site"), "news_source_id", "left")
    return named.groupBy("news_site", *period).agg(F.sum("article_count").alias("article_count"))


def by_source_month(fact: DataFrame, source_dim: DataFrame) -> DataFrame:
    return by_source_period(fact, source_dim, MONTH)


def by_type_month(fact: DataFrame) -> DataFrame:
    """Items per content type and month."""
    return _count(fact, ("content_type", *MONTH))


def by_topic_period(fact: DataFrame, topic_dim: DataFrame, period: Sequence[str] = DAY) -> DataFrame:
    """Items per topic and period; a type without a topic keeps its rows under a NULL name."""
    counted = _count(fact, ("content_type", *period))
    named = counted.join(topic_dim, F.col("content_type") == F.col("topic_id"), "left")
    return named.select("content_type", "topic_name", *period, "article_count")


def detail(fact: DataFrame, source_dim: DataFrame, topic_dim: DataFrame) -> DataFrame:
    """Every fact row with the names behind its ids."""
    sourced = join_dimension(fact, source_dim.select("news_source_id", "news_site"), "news_source_id")
    named = join_dimension(sourced, topic_dim, F.col("content_type") == F.col("topic_id"))
    return named.select(
        "article_id", "content_type", "news_source_id", "news_site", "topic_id", "topic_name",
        "title", "published_at", "updated_at", "year", "month", "day",
    )


def recent_items(
    fact: DataFrame, source_dim: DataFrame, topic_dim: DataFrame, limit: int | None = None
) -> DataFrame:
    """Listing columns of every item, or of the ``limit`` most recently published.

    The top rows are chosen on the facts; only they are joined.
    """
    if limit is not None:
        newest = [F.col("published_at").desc_nulls_last(), "article_id", "content_type"]
        fact = fact.orderBy(*newest).limit(limit)
    rows = detail(fact, source_dim, topic_dim).select(
        "article_id", "content_type", "news_site", "topic_name", "title", "published_at"
    )
    return rows if limit is None else rows.orderBy(*newest)


def topic_trend(fact: DataFrame, topic_dim: DataFrame, limit: int = 50) -> DataFrame:
    """Latest months first, busiest topic first within a month."""
    trend = by_topic_period(fact, topic_dim, MONTH)
    order = [F.desc("year"), F.desc("month"), F.desc("article_count"), "content_type"]
    return trend.orderBy(*order).limit(limit).select("topic_name", "year", "month", "article_count")


def top_sources(fact: DataFrame, source_dim: DataFrame, limit: int = 20) -> DataFrame:
    """Sources by total items, counted over the whole time at once rather than month by month."""
    totals = by_source_period(fact, source_dim, ()).withColumnRenamed("article_count", "total_publications")
    named = totals.filter(F.col("news_site").isNotNull())
    return named.orderBy(F.desc("total_publications"), "news_site").limit(limit)


def recent_sources(fact: DataFrame, source_dim: DataFrame, limit: int = 30) -> DataFrame:
    """Busiest sources of the latest months."""
    named = by_source_month(fact, source_dim).filter(F.col("news_site").isNotNull())
    order = [F.desc("year"), F.desc("month"), F.desc("article_count"), "news_site"]
    return named.orderBy(*order).limit(limit)


def register_views(fact: DataFrame, source_dim: DataFrame, topic_dim: DataFrame) -> None:
    """Expose the marts to SQL; each is recomputed from the stored tables when read."""
    views = {
        "agg_articles_by_month": by_month(fact),
        "agg_articles_by_source_month": by_source_month(fact, source_dim),
        "v_agg_articles_by_content_type_month": by_type_month(fact),
        "v_fact_article_detail": detail(fact, source_dim, topic_dim),
        "v_articles_recent": recent_items(fact, source_dim, topic_dim),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)

"""Star schema: source and topic dimensions, article facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from galley.functions.literals import constant_rows, empty_rows
from galley.functions.text import not_blank, version_key
from galley.operators.conform import conform
from galley.operators.joins import join_dimension
from galley.operators.ranking import number_rows
from galley.schemas import DIM_NEWS_SOURCE, DIM_TOPIC, FACT_ARTICLE
from galley.session import materialize

# One topic per content type (fixed values).
TOPICS = [("article", "Article"), ("blog", "Blog"), ("report", "Report")]

_SOURCE_COLUMNS = ("news_source_id", "news_site", "version")
_FACT_COLUMNS = (
    "article_id", "content_type", "news_source_id", "title", "published_at", "updated_at", "year", "month", "day",
)


def listed_sites(info: DataFrame) -> DataFrame:
    """Distinct named sites with their highest version number."""
    return (
        info.filter(not_blank("news_site"))
        .groupBy("news_site")
        .agg(F.max_by("version", F.struct(version_key("version"), "version")).alias("version"))
    )


def build_source_dim(info: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Rows to upsert into the source dimension.

    Known sites keep their id. New ones are numbered by name from the highest id in use, so
    the same input always gives the same ids and none is skipped.
    """
    sites = listed_sites(info)
    if current is None:
        return number_rows(sites, ["news_site"], name="news_source_id").select(*_SOURCE_COLUMNS)
    sites = materialize(sites, "sites")
    ids = current.select("news_site", "news_source_id")
    known = join_dimension(sites, ids, "news_site", "inner")
    new = number_rows(join_dimension(sites, ids, "news_site", "left_anti"), ["news_site"], name="_n")
    highest = current.agg(F.coalesce(F.max("news_source_id"), F.lit(0).cast("long"))).scalar()
    added = new.withColumn("news_source_id", highest + F.col("_n"))
    return known.select(*_SOURCE_COLUMNS).unionByName(added.select(*_SOURCE_COLUMNS))


def empty_source_dim(spark: SparkSession) -> DataFrame:
    return empty_rows(spark, DIM_NEWS_SOURCE)


def build_topic_dim(spark: SparkSession, topics: list[tuple[str, str]] = TOPICS) -> DataFrame:
    return constant_rows(spark, topics, DIM_TOPIC)


def build_fact(content: DataFrame, source_dim: DataFrame) -> DataFrame:
    """One fact row per item; a site the dimension does not hold gives a NULL source id."""
    if "news_site" not in content.columns:
        content = content.withColumn("news_site", F.lit(None).cast("string"))
    ids = source_dim.select("news_site", "news_source_id")
    joined = join_dimension(content, ids, "news_site", "left")
    return joined.withColumnRenamed("id", "article_id").select(*_FACT_COLUMNS)


def empty_fact(spark: SparkSession) -> DataFrame:
    """No rows, the declared columns: timestamps are timestamps here as in loaded facts."""
    return empty_rows(spark, FACT_ARTICLE)


def typed_fact(fact: DataFrame) -> DataFrame:
    """Facts with exactly the stored column types."""
    return conform(fact, FACT_ARTICLE)

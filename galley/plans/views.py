"""The marts as views stored in the session catalog: SQL text over the stored star, worked out when read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from galley.plans.run import Layout
from galley.schemas import TABLES, Table
from galley.sources.tables import ensure_table, is_path

_TRACKED = "spark.sql.hive.manageFilesourcePartitions"
_STAR = ("fact_article", "dim_news_source", "dim_topic")

# View and column names are fixed values. Counts are taken on the facts' own columns; names come after.
VIEWS = {
    "agg_articles_by_month": "SELECT year, month, count(1) AS article_count FROM {fact_article} GROUP BY year, month",
    "agg_articles_by_source_month": """
        WITH counted AS (SELECT news_source_id, year, month, count(1) AS n FROM {fact_article} GROUP BY ALL)
        SELECT source.news_site, counted.year, counted.month, sum(counted.n) AS article_count
        FROM counted LEFT JOIN {dim_news_source} AS source USING (news_source_id) GROUP BY ALL""",
    "v_agg_articles_by_content_type_month": """
        SELECT content_type, year, month, count(1) AS article_count FROM {fact_article} GROUP BY content_type, year, month""",
    "v_fact_article_detail": """
        SELECT article_id, content_type, fact.news_source_id, news_site, topic_id, topic_name, title, published_at, updated_at, year, month, day
        FROM {fact_article} AS fact LEFT JOIN {dim_news_source} AS source ON source.news_source_id = fact.news_source_id
        LEFT JOIN {dim_topic} ON topic_id = content_type""",
    "v_articles_recent": """
        SELECT article_id, content_type, news_site, topic_name, title, published_at
        FROM {fact_article} AS fact LEFT JOIN {dim_news_source} AS source ON source.news_source_id = fact.news_source_id
        LEFT JOIN {dim_topic} ON topic_id = content_type""",
}


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _registered(spark: SparkSession, namespace: str, spec: Table, path: str) -> str:
    """A path table of the star under a name in the catalog, with its declared columns."""
    name = f"{namespace}.{spec.name}"
    ensure_table(spark, path, spec.schema, spec.partition_cols)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields)
    parts = f"PARTITIONED BY ({', '.join(spec.partition_cols)})" if spec.partition_cols else ""
    # Only the name is dropped: a table with a location keeps its files.
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    before = spark.conf.get(_TRACKED)
    # Partitions are found in the folders when the table is read, so a load need not announce them.
    spark.conf.set(_TRACKED, "false")
    try:
        spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet {parts} LOCATION '{path}'")
    finally:
        spark.conf.set(_TRACKED, before)
    return name


def publish_views(spark: SparkSession, layout: Layout, namespace: str) -> list[str]:
    """Create or replace the five views in ``namespace`` of the session catalog, made if absent; returns their names.

    Any session of that catalog can then read them, with whatever the tables hold by then. Tables at
    paths are registered beside them. Tables of a catalog are read under their own names.
    """
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
    star = {}
    for name in _STAR:
        where = layout.table(name)
        star[name] = _quoted(_registered(spark, namespace, TABLES[name], where) if is_path(where) else where)
    for view, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(f'{namespace}.{view}')} AS {text.format(**star)}")
    return [f"{namespace}.{view}" for view in VIEWS]

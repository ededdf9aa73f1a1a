"""How the supplied tables play the parts of publication data, in Spark and in SQL.

=================  =====================================================================
content item       orders with the customer's nation as news site and priority as type
source dimension   nations outside one region, so that some items have no known source
topic dimension    four of the five priorities
site list          suppliers: their nation as site, their number in the version
versions of a key  events per (event_type, user_id), the time as update time
texts              documents, dated by the order of the same number
=================  =====================================================================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from galley.functions.dates import with_date_parts
from galley.plans.star import build_fact

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its twin."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# Columns of the supplied tables, declared so that no file is opened to infer them.
TABLE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def content(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as content items. ``updated_at`` is some seconds after publication."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal")
    seconds = F.floor("o_totalprice")
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderpriority").alias("content_type"),
            F.col("n_name").alias("news_site"),
            F.col("o_orderstatus").alias("title"),
            F.col("o_orderdate").alias("published_at"),
            (F.col("o_orderdate") + F.make_dt_interval(secs=seconds)).alias("updated_at"),
            F.col("c_name").alias("writer"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )
    )


CONTENT = """
content AS (
  SELECT o_orderkey AS id, o_orderpriority AS content_type, n_name AS news_site,
         o_orderstatus AS title, o_orderdate AS published_at,
         o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS updated_at,
         c_name AS writer, c_mktsegment AS segment, c_acctbal AS balance,
         strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
         strftime(o_orderdate, '%d') AS day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def dated_content(spark: SparkSession, folder: str) -> DataFrame:
    return with_date_parts(content(spark, folder), "published_at")


def source_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Nations of every region but Europe; the id is the nation number plus one."""
    regions = table(spark, folder, "region").filter(F.col("r_name") != "EUROPE")
    return (
        table(spark, folder, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("n_nationkey") + 1).cast("long").alias("news_source_id"),
            F.col("n_name").alias("news_site"),
            F.concat(F.lit("4."), F.col("n_nationkey"), F.lit(".0")).alias("version"),
        )
    )


SOURCE_DIM = """
source_dim AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS news_source_id, n_name AS news_site,
         '4.' || n_nationkey || '.0' AS version
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE'
)"""

TOPIC_ROWS = [("1-URGENT", "Urgent"), ("2-HIGH", "High"), ("3-MEDIUM", "Medium"), ("5-LOW", "Low")]
TOPIC_DIM = """
topic_dim AS (
  SELECT * FROM (VALUES ('1-URGENT', 'Urgent'), ('2-HIGH', 'High'), ('3-MEDIUM', 'Medium'),
                        ('5-LOW', 'Low')) AS t(topic_id, topic_name)
)"""


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return build_fact(dated_content(spark, folder), source_dim(spark, folder))


FACT = """
fact AS (
  SELECT id AS article_id, content_type, news_source_id, title, published_at, updated_at, year, month, day
  FROM content LEFT JOIN source_dim USING (news_site)
)"""


def with_parts(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


STAR = with_parts(CONTENT, SOURCE_DIM, TOPIC_DIM, FACT)


def info(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as info records: version from their number, sites as a native list."""
    nations = table(spark, folder, "nation")
    return (
        table(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("id"),
            F.lit("info").alias("content_type"),
            F.concat(F.lit("4."), F.col("s_suppkey"), F.lit(".0")).alias("version"),
            F.array("n_name", "s_name").alias("news_sites"),
        )
    )

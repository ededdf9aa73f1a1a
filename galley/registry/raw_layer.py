"""Landed pages, tagging, the raw layer, and what is read from it."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from galley.operators.incremental import after_marks, high_water_marks, within_dates
from galley.operators.ranking import cap_per_group
from galley.plans.run import Layout, stored
from galley.registry.base import CONTENT, content, info, query, table, with_parts
from galley.session import scratch_path
from galley.sources import bronze, landed
from galley.streaming import landed_stream

EVENT_TYPES = {"click": "article", "view": "blog", "purchase": "report"}
_TAG = "CASE event_type WHEN 'click' THEN 'article' WHEN 'view' THEN 'blog' WHEN 'purchase' THEN 'report' END"

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


@query(
    "s1_flatten_pages",
    f"""
    SELECT event_id AS id, event_type AS title, {_SQL_ISO} AS published_at, 2 * event_id AS arrival,
           CAST(2 AS BIGINT) AS declared_total, 'article' AS content_type
    FROM events
    UNION ALL
    SELECT user_id, props, {_SQL_ISO}, 2 * event_id + 1, 2, 'article' FROM events
    """,
)
def s1_flatten_pages(spark, folder):
    """Every event lands as a page of two items; the pages are read back flat."""
    published = F.date_format("ts", _ISO).alias("published_at")
    first = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title"), published)
    second = F.struct(F.col("user_id").alias("id"), F.col("props").alias("title"), published)
    link = F.concat(F.lit("https://example.org/articles/?limit=2&offset="), (2 * F.col("event_id") + 2).cast("string"))
    pages = table(spark, folder, "events").select(
        F.lit(2).alias("count"), link.alias("next"), F.array(first, second).alias("results"), F.lit("articles").alias("endpoint")
    )
    path = scratch_path(spark, "landing")
    pages.write.partitionBy("endpoint").json(path)
    items = landed.read_pages(spark, path)
    return items.select("id", "title", "published_at", "arrival", "declared_total", "content_type")


_PAGE_SQL = """
    SELECT CASE WHEN event_id % 5 < 3 THEN 'articles' ELSE 'blogs' END AS endpoint, 3 * event_id AS start,
           CASE WHEN event_id % 7 = 0 THEN 5 WHEN event_id % 11 = 0 THEN 1 ELSE 3 END AS n,
           3 * (SELECT max(event_id) FROM events) - 1 AS total,
           CASE WHEN event_id % 17 = 0 THEN 'unreadable' WHEN event_id % 19 = 0 THEN 'no results'
                WHEN event_id % 23 = 0 THEN 'partly read' END AS reason, event_id
    FROM events WHERE event_id % 13 <> 5"""


def _damaged_pages(spark, folder) -> str:
    """Two listings of three places a page, as landed JSON lines: some pages are longer or shorter,
    never landed, cut off, error messages, or hold a field of another type."""
    n, at = F.col("event_id"), 3 * F.col("event_id")
    size = F.when(n % 7 == 0, 5).when(n % 11 == 0, 1).otherwise(3)
    events = table(spark, folder, "events").select("event_id").filter(n % 13 != 5)
    total = table(spark, folder, "events").agg((3 * F.max("event_id") - 1).alias("t")).scalar()
    flag = F.when((n % 23 == 0) & (n % 17 != 0), F.lit('"no"')).otherwise(F.lit("true"))
    item = F.transform(F.sequence(at, at + size - 1), lambda i: F.concat(F.lit('{"id":'), i.cast("string"), F.lit(',"featured":'), flag, F.lit("}")))
    link = F.concat(F.lit("https://example.org/?limit=3&offset="), (at + 3).cast("string"))
    page = F.concat(
        F.lit('{"count":'), total.cast("string"), F.lit(',"next":"'), link, F.lit('","results":['), F.array_join(item, ","), F.lit("]}")
    )
    line = F.when(n % 17 == 0, F.expr("substring(page, 1, length(page) - 4)")).when(
        n % 19 == 0, F.concat(F.lit('{"next":"'), link, F.lit('"}'))
    ).otherwise(F.col("page"))
    path = scratch_path(spark, "landing")
    endpoint = F.when(n % 5 < 3, "articles").otherwise("blogs").alias("endpoint")
    events.withColumn("page", page).select(line.alias("value"), endpoint).write.partitionBy("endpoint").text(path)
    return path


@query(
    "s1_chain_gaps",
    f"""
    WITH pages AS ({_PAGE_SQL}),
         good AS (SELECT * FROM pages WHERE reason IS NULL OR reason = 'partly read'),
         borders AS (
           SELECT endpoint, start AS place, 1 AS d, 0 AS f FROM good UNION ALL SELECT endpoint, start + n, -1, 0 FROM good
           UNION ALL SELECT DISTINCT endpoint, 0, 0, 1 FROM pages UNION ALL SELECT DISTINCT endpoint, total, 0, -1 FROM pages),
         added AS (SELECT endpoint, place, sum(d) AS d, sum(f) AS f FROM borders GROUP BY endpoint, place),
         summed AS (SELECT endpoint, place, sum(d) OVER w AS d, sum(f) OVER w AS f, lead(place) OVER w AS until FROM added
                    WINDOW w AS (PARTITION BY endpoint ORDER BY place)),
         kinds AS (SELECT endpoint, place, until, CASE WHEN d >= 2 THEN 'repeated' WHEN d = 1 AND f = 0 THEN 'beyond'
                          WHEN d = 0 AND f > 0 THEN 'missing' END AS kind FROM summed WHERE until IS NOT NULL),
         runs AS (SELECT *, CASE WHEN kind IS DISTINCT FROM lag(kind) OVER (PARTITION BY endpoint ORDER BY place) THEN 1 ELSE 0 END AS new FROM kinds),
         numbered AS (SELECT *, sum(new) OVER (PARTITION BY endpoint ORDER BY place) AS run FROM runs)
    SELECT endpoint, kind, min(place) AS first, max(until) AS until FROM numbered WHERE kind IS NOT NULL GROUP BY endpoint, kind, run
    """,
)
def s1_chain_gaps(spark, folder):
    """Places of two listings that the landed pages do not hold exactly once."""
    return landed.chain_gaps(landed.read_envelopes(spark, _damaged_pages(spark, folder)))


@query(
    "s1_corrupt_pages",
    f"""SELECT endpoint, reason, CAST(CASE WHEN reason <> 'no results' THEN total END AS BIGINT) AS declared_total, start + 3 AS next_start
        FROM ({_PAGE_SQL}) WHERE reason IS NOT NULL""",
)
def s1_corrupt_pages(spark, folder):
    """Every page that is not as declared, with what its text still tells."""
    broken = landed.broken_pages(landed.read_envelopes(spark, _damaged_pages(spark, folder)))
    following = F.regexp_extract("page", r"offset=(\d+)", 1).cast("long")
    return broken.select("endpoint", "reason", "declared_total", following.alias("next_start"))


@query("s2_tag_type", f"SELECT event_id, event_type AS endpoint, {_TAG} AS content_type FROM events")
def s2_tag_type(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("event_type").alias("endpoint"))
    return landed.tag_type(events, mapping=EVENT_TYPES)


@query(
    "s3_combine",
    """
    SELECT event_id AS id, event_type AS content_type, value AS amount, CAST(NULL AS BIGINT) AS reader,
           CAST(NULL AS VARCHAR) AS version
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, event_type, NULL, user_id, NULL FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, event_type, NULL, NULL, NULL FROM events WHERE event_type NOT IN ('click', 'view')
    UNION ALL SELECT 0, 'info', NULL, NULL, '4.' || COUNT(*) || '.0' FROM events
    """,
)
def s3_combine(spark, folder):
    """Three listings of different shape and the info record in one frame."""
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("content_type"), "value", "user_id"
    )
    kind = F.col("content_type")
    clicks = events.filter(kind == "click").select("id", "content_type", F.col("value").alias("amount"))
    views = events.filter(kind == "view").select("id", "content_type", F.col("user_id").alias("reader"))
    rest = events.filter(~kind.isin("click", "view")).select("id", "content_type")
    version = F.concat(F.lit("4."), F.count("*").cast("string"), F.lit(".0"))
    record = events.agg(version.alias("version")).withColumn("news_sites", F.array().cast("array<string>"))
    combined = landed.combine([clicks, views, rest], landed.info_item(record))
    return combined.select("id", "content_type", "amount", "reader", "version")


# The orders dated up to here are loaded on the first of two days, the rest on the second.
_FIRST_LOAD_END = "1998-06-30 00:00:00"


def _two_loads(spark, folder) -> str:
    items = content(spark, folder)
    late = F.col("published_at") > F.lit(_FIRST_LOAD_END).cast("timestamp_ntz")
    path = scratch_path(spark, "bronze")
    bronze.write_bronze(items.filter(~late), None, path, "2024-01-31")
    bronze.write_bronze(items.filter(late), info(spark, folder), path, "2024-02-01")
    return path


@query(
    "s4_partition_scan",
    with_parts(CONTENT)
    + f"""SELECT id, content_type, title, news_site, '2024' AS year, '02' AS month, '01' AS day
    FROM content WHERE published_at > TIMESTAMP '{_FIRST_LOAD_END}'
    UNION ALL SELECT s_suppkey, 'info', NULL, NULL, '2024', '02', '01' FROM supplier""",
)
def s4_partition_scan(spark, folder):
    """All types loaded on the second day."""
    day = bronze.read_bronze(spark, _two_loads(spark, folder), "2024-02-01")
    return day.select("id", "content_type", "title", "news_site", "year", "month", "day")


@query(
    "s5_type_scan",
    """SELECT s_suppkey AS id, 'info' AS content_type, '4.' || s_suppkey || '.0' AS version,
              n_name || '|' || s_name AS sites
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def s5_type_scan(spark, folder):
    """The info folder of one day, with its own schema."""
    rows = bronze.read_bronze(spark, _two_loads(spark, folder), "2024-02-01", "info")
    return rows.select("id", "content_type", "version", F.concat_ws("|", "news_sites").alias("sites"))


@query(
    "s6_inspect",
    """SELECT c.column, c.type, (SELECT COUNT(*) FROM supplier) AS row_count
       FROM (VALUES ('id', 'bigint'), ('content_type', 'string'), ('version', 'string'),
                    ('news_sites', 'array<string>'), ('year', 'string'), ('month', 'string'),
                    ('day', 'string')) AS c("column", type)""",
)
def s6_inspect(spark, folder):
    """Schema and size of the info rows of both days."""
    schema, size, _rows = bronze.inspect(bronze.read_bronze(spark, _two_loads(spark, folder), content_type="info"))
    return schema.withColumn("row_count", size.scalar())


@query(
    "s6_inspect_rows",
    """SELECT s_suppkey AS id, 'info' AS content_type, '4.' || s_suppkey || '.0' AS version, n_name || '|' || s_name AS news_sites
       FROM supplier JOIN nation ON s_nationkey = n_nationkey ORDER BY s_suppkey LIMIT 50""",
)
def s6_inspect_rows(spark, folder):
    """The rows shown: the first fifty of the info rows of both days."""
    rows = bronze.read_bronze(spark, _two_loads(spark, folder), content_type="info")
    shown = bronze.inspect(rows, order_by=("id",))[2]
    return shown.select("id", "content_type", "version", F.concat_ws("|", "news_sites").alias("news_sites"))


@query(
    "k1_bronze_roundtrip",
    with_parts(CONTENT)
    + f"""SELECT content_type, year, month, day, COUNT(*) AS row_count, CAST(SUM(id) AS BIGINT) AS id_sum FROM (
      SELECT content_type, id, '2024' AS year, CASE WHEN published_at > TIMESTAMP '{_FIRST_LOAD_END}' THEN '02' ELSE '01' END AS month,
             CASE WHEN published_at > TIMESTAMP '{_FIRST_LOAD_END}' THEN '01' ELSE '31' END AS day FROM content
      UNION ALL SELECT 'info', s_suppkey, '2024', '02', '01' FROM supplier)
    GROUP BY ALL""",
)
def k1_bronze_roundtrip(spark, folder):
    """Everything appended on both days, by folder."""
    rows = bronze.read_bronze(spark, _two_loads(spark, folder))
    return rows.groupBy("content_type", "year", "month", "day").agg(
        F.count("*").alias("row_count"), F.sum("id").alias("id_sum")
    )


@query(
    "k1_rerun_same_day",
    with_parts(CONTENT)
    + """SELECT content_type, COUNT(*) AS row_count, CAST(SUM(id) AS BIGINT) AS id_sum FROM (
           SELECT content_type, id FROM content WHERE content_type <> '5-LOW'
           UNION ALL SELECT content_type, id FROM content WHERE id % 10 = 0
           UNION ALL SELECT 'info', s_suppkey FROM supplier)
         GROUP BY content_type""",
)
def k1_rerun_same_day(spark, folder):
    """One day in two loads, the first of them run twice: the second run knows one type less."""
    items = content(spark, folder)
    path = scratch_path(spark, "bronze")
    bronze.write_bronze(items, info(spark, folder), path, "2024-02-01", load="morning")
    bronze.write_bronze(items.filter(F.col("id") % 10 == 0), None, path, "2024-02-01", load="evening")
    bronze.write_bronze(items.filter(F.col("content_type") != "5-LOW"), info(spark, folder), path, "2024-02-01", load="morning")
    rows = bronze.read_bronze(spark, path, "2024-02-01")
    return rows.groupBy("content_type").agg(F.count("*").alias("row_count"), F.sum("id").alias("id_sum"))


@query(
    "k2_nested_json",
    with_parts(CONTENT)
    + """SELECT id, '[{"name":"' || writer || '","socials":{"x":"' || segment || '"}},{"name":"' || news_site || '"}]' AS authors
         FROM content""",
)
def k2_nested_json(spark, folder):
    social = T.StructType([T.StructField("x", T.StringType())])
    first = F.struct(F.col("writer").alias("name"), F.struct(F.col("segment").alias("x")).alias("socials"))
    second = F.struct(F.col("news_site").alias("name"), F.lit(None).cast(social).alias("socials"))
    items = content(spark, folder).select("id", F.array(first, second).alias("authors"))
    return bronze.nested_as_json(items)


@query(
    "k3_split_sink",
    """SELECT 'info' AS sink, COALESCE(NULLIF(o_orderkey, 0), 0) AS id, 'info' AS content_type, COALESCE(version, '') AS version
       FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'Info' WHEN '2-HIGH' THEN 'INFO' WHEN '3-MEDIUM' THEN NULL ELSE 'blog' END AS kind,
                    CASE WHEN o_orderstatus = 'F' THEN '4.1.0' END AS version FROM orders)
       WHERE LOWER(kind) = 'info'
       UNION ALL
       SELECT 'content', o_orderkey, kind, NULL
       FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'Info' WHEN '2-HIGH' THEN 'INFO' WHEN '3-MEDIUM' THEN NULL ELSE 'blog' END AS kind,
                    CASE WHEN o_orderstatus = 'F' THEN '4.1.0' END AS version FROM orders)
       WHERE kind IS NULL OR LOWER(kind) <> 'info'""",
)
def k3_split_sink(spark, folder):
    """Mixed rows sent to the sink: routed by type without regard to case, info gaps filled; both read back."""
    priority = F.col("o_orderpriority")
    kind = (
        F.when(priority == "1-URGENT", "Info").when(priority == "2-HIGH", "INFO").when(priority != "3-MEDIUM", "blog")
    )
    records = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        kind.alias("content_type"),
        F.when(F.col("o_orderstatus") == "F", "4.1.0").alias("version"),
    )
    path = scratch_path(spark, "split")
    bronze.write_bronze(records, None, path, "2024-02-01")
    info_rows = bronze.read_bronze(spark, path, "2024-02-01", "info")
    rows = bronze.read_bronze(spark, path, "2024-02-01").filter(F.coalesce("content_type", F.lit("")) != "info")
    return info_rows.select(F.lit("info").alias("sink"), "id", "content_type", "version").unionByName(
        rows.select(F.lit("content").alias("sink"), "id", "content_type", F.lit(None).cast("string").alias("version"))
    )


def _events_as_items(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("content_type"),
        F.col("ts").alias("published_at"),
        F.col("ts").alias("updated_at"),
        "value",
    )


def _cap_sql(n: int) -> str:
    return f"""SELECT event_id AS id, event_type AS content_type, value FROM events
               QUALIFY ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= {n}"""


@query("w7_cap_per_type", _cap_sql(50))
def w7_cap_per_type(spark, folder):
    items = _events_as_items(spark, folder)
    capped = cap_per_group(items, ["content_type"], [F.desc("published_at"), "id"], "50")
    return capped.select("id", "content_type", "value")


@query("w7_cap_per_type_large", _cap_sql(1500))
def w7_cap_per_type_large(spark, folder):
    """A cap above what Spark prunes on the map side: numbered over range partitions."""
    items = _events_as_items(spark, folder)
    capped = cap_per_group(items, ["content_type"], [F.desc("published_at"), "id"], 1500)
    return capped.select("id", "content_type", "value")


@query(
    "i1_watermark_filter",
    """WITH items AS (SELECT event_id AS id, event_type AS content_type,
                             CASE WHEN event_id % 13 <> 0 THEN date_trunc('day', ts) END AS published_at,
                             CASE WHEN event_id % 7 <> 0 THEN date_trunc('hour', ts) END AS updated_at, ts FROM events),
            marks AS (SELECT content_type, MAX(updated_at) AS u, MAX(published_at) AS p FROM items
                      WHERE ts < TIMESTAMP '2024-01-16 00:00:00' AND content_type <> 'signup' GROUP BY content_type)
       SELECT id, items.content_type, updated_at FROM items LEFT JOIN marks USING (content_type)
       WHERE CASE WHEN updated_at IS NOT NULL THEN u IS NULL OR updated_at >= u
                  ELSE published_at IS NULL OR p IS NULL OR published_at >= p END""",
)
def i1_watermark_filter(spark, folder):
    """Half a month is stored, one type not at all; times tie and are missing. What of everything is new?"""
    items = _events_as_items(spark, folder).withColumn("ts", F.col("updated_at"))
    items = items.withColumns({
        "published_at": F.when(F.col("id") % 13 != 0, F.date_trunc("day", "ts").cast("timestamp_ntz")),
        "updated_at": F.when(F.col("id") % 7 != 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")),
    })
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    kept = items.filter((F.col("ts") < cut) & (F.col("content_type") != "signup"))
    return after_marks(items, high_water_marks(kept)).select("id", "content_type", "updated_at")


@query(
    "i2_date_bounds",
    with_parts(CONTENT)
    + """SELECT id, content_type, published_at, updated_at FROM content
         WHERE published_at >= TIMESTAMP '1996-01-01' AND published_at <= TIMESTAMP '1999-12-31'
           AND updated_at >= TIMESTAMP '1996-02-01'""",
)
def i2_date_bounds(spark, folder):
    def stamp(text):
        return F.lit(text).cast("timestamp_ntz")

    items = within_dates(content(spark, folder), stamp("1996-01-01"), stamp("1999-12-31"), stamp("1996-02-01"))
    return items.select("id", "content_type", "published_at", "updated_at")


@query(
    "k5_stream_upsert",
    """SELECT user_id AS id, MAX(ts) AS updated_at, COUNT(*) AS article_count FROM (
         SELECT DISTINCT user_id, ts FROM events) GROUP BY user_id""",
)
def k5_stream_upsert(spark, folder):
    """Events as versions of items, landed twice over, read as a stream in several batches: the newest of each is stored.

    Beside it the versions that the stream let through, each of them once.
    """
    stamp = F.date_format("ts", _ISO)
    item = F.struct(F.col("user_id").alias("id"), stamp.alias("published_at"), stamp.alias("updated_at"))
    root, seen = scratch_path(spark, "stream"), scratch_path(spark, "seen")
    pages = table(spark, folder, "events").select(F.array(item).alias("results"), F.lit("articles").alias("endpoint"))
    for _ in range(2):
        pages.repartition(2).write.mode("append").partitionBy("endpoint").json(f"{root}/landing")
    layout = Layout(bronze=f"{root}/b", silver=f"{root}/s", gold=f"{root}/g")
    items = landed_stream.stream_items(spark, f"{root}/landing", max_files_per_trigger=2)
    landed_stream.upsert_stream(items, layout, "2024-02-01", f"{root}/checkpoint").awaitTermination()
    once = landed_stream.new_versions(items.select("id", "content_type", "updated_at"), "7 days")
    once.writeStream.format("parquet").option("path", seen).option("checkpointLocation", f"{root}/seen-log").trigger(availableNow=True).start().awaitTermination()
    versions = spark.read.parquet(seen).groupBy("id").agg(F.count("*").alias("article_count"))
    newest = stored(spark, layout, "articles").select("id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))
    return newest.join(versions, "id")

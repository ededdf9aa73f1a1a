"""Projections, deduplication, list parsing, unions, validation."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from galley.functions.dates import parse_run_date, parse_timestamp, with_date_parts, with_text_date_parts
from galley.functions.text import not_blank, parse_list
from galley.operators import conform, dedup, quality
from galley.plans import silver
from galley.registry.base import (
    CONTENT,
    SOURCE_DIM,
    content,
    dated_content,
    fact,
    query,
    source_dim,
    table,
    with_parts,
)
from galley.registry.base import FACT as FACT_SQL
from galley.schemas import AUTHOR, EVENT, LAUNCH, SOCIALS

_TABLES = {"click": "clicks", "view": "views", "purchase": "purchases"}


def _versions(spark, folder):
    """Events as repeated versions of (content_type, id)."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("content_type"),
        F.col("user_id").alias("id"),
        F.col("ts").alias("updated_at"),
        "event_id",
        "value",
    )


_VERSIONS = "SELECT event_type AS content_type, user_id AS id, ts AS updated_at, event_id, value FROM events"


@query(
    "p1_split_by_type",
    """SELECT CASE event_type WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' WHEN 'purchase' THEN 'purchases'
                              ELSE 'unrouted' END AS table_name, event_id, value FROM events""",
)
def p1_split_by_type(spark, folder):
    """Every event in the table of its type; types without a table are told, not lost."""
    events = table(spark, folder, "events")
    parts = conform.split_by_value(events, "event_type", _TABLES)
    parts["unrouted"] = events.filter(~F.coalesce(F.col("event_type").isin(*_TABLES), F.lit(False)))
    named = [df.select(F.lit(name).alias("table_name"), "event_id", "value") for name, df in parts.items()]
    return conform.union_all(named)


@query(
    "p2_date_parts",
    """SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
              strftime(ts, '%Y-%m-%d') AS text_date FROM events""",
)
def p2_date_parts(spark, folder):
    """Date parts from the parsed column, and from ISO text beside them."""
    events = table(spark, folder, "events").select("event_id", "ts", F.col("ts").cast("string").alias("iso"))
    parsed = with_date_parts(events, "ts")
    both = with_text_date_parts(parsed, "iso", ("_y", "_m", "_d"))
    return both.select("event_id", "year", "month", "day", F.concat_ws("-", "_y", "_m", "_d").alias("text_date"))


@query("p3_run_date_parts", "SELECT s_suppkey, '2024' AS year, '02' AS month, '09' AS day FROM supplier")
def p3_run_date_parts(spark, folder):
    return with_date_parts(table(spark, folder, "supplier").select("s_suppkey"), parse_run_date("2024-02-09"))


@query(
    "p4_ingestion_stamp",
    with_parts(CONTENT)
    + """SELECT id, year, '2024' AS ingestion_year, '02' AS ingestion_month, '09' AS ingestion_day FROM content""",
)
def p4_ingestion_stamp(spark, folder):
    stamped = silver.stamp_ingestion(dated_content(spark, folder), "2024-02-09")
    return stamped.select("id", "year", "ingestion_year", "ingestion_month", "ingestion_day")


@query(
    "p5_conform",
    """SELECT CAST(NULL AS BIGINT) AS id, s_name AS news_site, CAST(NULL AS VARCHAR) AS version,
              CAST(s_nationkey AS BIGINT) AS nation FROM supplier""",
)
def p5_conform(spark, folder):
    """Absent columns become typed NULLs, present ones take the declared type and order."""
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("news_site", T.StringType()),
            T.StructField("version", T.StringType()),
            T.StructField("nation", T.LongType()),
        ]
    )
    suppliers = table(spark, folder, "supplier").withColumnsRenamed({"s_name": "news_site", "s_nationkey": "nation"})
    return conform.conform(suppliers, schema)


def _by_segment(spark, folder):
    items = dated_content(spark, folder)
    full = items.filter(F.col("content_type") == "1-URGENT")
    bare = items.filter(F.col("content_type") == "2-HIGH").drop("news_site")
    rest = items.filter(~F.col("content_type").isin("1-URGENT", "2-HIGH")).drop("balance")
    return {"article": full, "blog": bare, "report": rest}


_TYPED = """SELECT id, CASE content_type WHEN '1-URGENT' THEN 'article' WHEN '2-HIGH' THEN 'blog' ELSE 'report' END AS content_type,
       CASE WHEN content_type <> '2-HIGH' THEN news_site END AS news_site,
       CASE WHEN content_type IN ('1-URGENT', '2-HIGH') THEN balance END AS balance, year, month, day FROM content"""


@query("p6_date_filter", with_parts(CONTENT) + _TYPED + " WHERE year = '1998' AND month = '10' AND day = '03'")
def p6_date_filter(spark, folder):
    """One publication day of every type."""
    stacked = conform.union_content(_by_segment(spark, folder), "1998-10-03")
    return stacked.select("id", "content_type", "news_site", "balance", "year", "month", "day")


@query("u1_union_by_name", with_parts(CONTENT) + _TYPED)
def u1_union_by_name(spark, folder):
    stacked = conform.union_content(_by_segment(spark, folder))
    return stacked.select("id", "content_type", "news_site", "balance", "year", "month", "day")


@query(
    "p7_not_blank",
    with_parts(CONTENT)
    + """SELECT id, site FROM (SELECT id, CASE WHEN balance < 0 THEN '' WHEN segment = 'MACHINERY' THEN NULL ELSE news_site END AS site FROM content)
         WHERE site IS NOT NULL AND site <> ''""",
)
def p7_not_blank(spark, folder):
    site = F.when(F.col("balance") < 0, "").when(F.col("segment") != "MACHINERY", F.col("news_site"))
    return content(spark, folder).select("id", site.alias("site")).filter(not_blank("site"))


@query(
    "w1_latest_per_key",
    f"SELECT * FROM ({_VERSIONS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY content_type, id ORDER BY updated_at DESC, event_id DESC) = 1",
)
def w1_latest_per_key(spark, folder):
    return dedup.latest_per_key(_versions(spark, folder))


@query(
    "w2_drop_duplicates",
    f"SELECT content_type, id, event_id, value FROM ({_VERSIONS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY content_type, id ORDER BY event_id, value) = 1",
)
def w2_drop_duplicates(spark, folder):
    """No update time to go by: a reproducible survivor."""
    return dedup.any_per_key(_versions(spark, folder).drop("updated_at"), ["content_type", "id"])


@query(
    "w3_first_per_key",
    f"SELECT * FROM ({_VERSIONS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY content_type, id ORDER BY updated_at, event_id) = 1",
)
def w3_first_per_key(spark, folder):
    return dedup.first_per_key(_versions(spark, folder), arrival=["updated_at", "event_id"])


@query(
    "w4_dedup_info",
    """SELECT '2024' AS year, '02' AS month, '09' AS day, n_name AS news_site, MAX(s_suppkey) AS id,
              '4.' || MAX(s_suppkey) || '.0' AS version
       FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
)
def w4_dedup_info(spark, folder):
    """One row per site and day, the highest version, where text order would pick another."""
    nations = table(spark, folder, "nation")
    listed = table(spark, folder, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = with_date_parts(listed, ("2024", "02", "09")).select(
        "year", "month", "day", F.col("n_name").alias("news_site"), F.col("s_suppkey").alias("id"),
        F.concat(F.lit("4."), F.col("s_suppkey"), F.lit(".0")).alias("version"),
    )
    return dedup.highest_version_per_key(rows, ["news_site", "year", "month", "day"])


def _list_text(spark, folder):
    """Order items with a site list as text: two names, a name with an apostrophe, or none."""
    quoted = F.concat(F.lit("['"), F.col("news_site"), F.lit("', '"), F.col("segment"), F.lit("']"))
    mixed = F.concat(F.lit('["O\'Hara '), F.col("segment"), F.lit("\", '"), F.col("writer"), F.lit("']"))
    title = F.col("title")
    text = F.when(title == "O", quoted).when(title == "P", mixed).otherwise("[]")
    return content(spark, folder).select("id", F.lit("info").alias("content_type"), "title", text.alias("news_sites"))


_LISTED = """
    SELECT id, news_site FROM content WHERE title = 'O'
    UNION ALL SELECT id, segment FROM content WHERE title = 'O'
    UNION ALL SELECT id, 'O''Hara ' || segment FROM content WHERE title = 'P'
    UNION ALL SELECT id, writer FROM content WHERE title = 'P'"""


@query(
    "g1_parse_list",
    with_parts(CONTENT)
    + """SELECT id, CAST(CASE WHEN title = 'F' THEN 0 ELSE 2 END AS INTEGER) AS n_sites,
         CASE title WHEN 'O' THEN news_site WHEN 'P' THEN 'O''Hara ' || segment END AS first_site FROM content""",
)
def g1_parse_list(spark, folder):
    sites = parse_list("news_sites")
    return _list_text(spark, folder).select("id", F.size(sites).alias("n_sites"), F.get(sites, F.lit(0)).alias("first_site"))


@query("g1_explode_sites", with_parts(CONTENT) + _LISTED)
def g1_explode_sites(spark, folder):
    return silver.explode_sites(_list_text(spark, folder)).select("id", "news_site")


@query(
    "g2_explode_authors",
    with_parts(CONTENT)
    + """SELECT id, writer AS author_name, segment AS x, CAST(NULL AS VARCHAR) AS youtube FROM content WHERE title <> 'F'
         UNION ALL SELECT id, news_site, NULL, NULL FROM content WHERE title = 'P'
         UNION ALL SELECT id, NULL, NULL, NULL FROM content WHERE title = 'F'""",
)
def g2_explode_authors(spark, folder):
    """Items with two authors, one, or none; accounts may be absent."""
    accounts = F.struct(
        F.col("segment").alias("x"), *[F.lit(None).cast("string").alias(f.name) for f in SOCIALS.fields if f.name != "x"]
    )
    lead = F.struct(F.col("writer").alias("name"), accounts.alias("socials")).cast(AUTHOR)
    second = F.struct(F.col("news_site").alias("name"), F.lit(None).cast(SOCIALS).alias("socials")).cast(AUTHOR)
    authors = F.when(F.col("title") == "P", F.array(lead, second)).when(F.col("title") == "O", F.array(lead))
    items = content(spark, folder).select("id", authors.alias("authors"))
    return silver.explode_authors(items).select("id", "author_name", "x", "youtube")


@query(
    "g2_explode_launches",
    with_parts(CONTENT)
    + """SELECT id, segment AS launch_id, writer AS launch_provider FROM content WHERE title <> 'F'
         UNION ALL SELECT id, news_site, NULL FROM content WHERE title = 'P'
         UNION ALL SELECT id, NULL, NULL FROM content WHERE title = 'F'""",
)
def g2_explode_launches(spark, folder):
    """Items with two launches, one, or none."""
    one = F.struct(F.col("segment").alias("launch_id"), F.col("writer").alias("provider")).cast(LAUNCH)
    two = F.struct(F.col("news_site").alias("launch_id"), F.lit(None).cast("string").alias("provider")).cast(LAUNCH)
    launches = F.when(F.col("title") == "P", F.array(one, two)).when(F.col("title") == "O", F.array(one))
    items = content(spark, folder).select("id", launches.alias("launches"))
    return silver.explode_launches(items).select("id", "launch_id", "launch_provider")


@query(
    "g2_explode_events",
    with_parts(CONTENT)
    + """SELECT id, CAST(id % 1000 AS INTEGER) AS event_id, news_site AS event_provider FROM content WHERE title = 'O'
         UNION ALL SELECT id, NULL, NULL FROM content WHERE title <> 'O'""",
)
def g2_explode_events(spark, folder):
    """Items with one event, with an empty list, or without a list."""
    one = F.struct((F.col("id") % 1000).cast("int").alias("event_id"), F.col("news_site").alias("provider")).cast(EVENT)
    events = F.when(F.col("title") == "O", F.array(one)).when(F.col("title") == "P", F.array().cast(T.ArrayType(EVENT)))
    items = content(spark, folder).select("id", events.alias("events"))
    return silver.explode_events(items).select("id", "event_id", "event_provider")


@query(
    "g2_parse_records",
    with_parts(CONTENT)
    + """SELECT id, writer AS author_name, CASE WHEN title = 'P' THEN segment END AS x FROM content WHERE title <> 'F'
         UNION ALL SELECT id, NULL, NULL FROM content WHERE title = 'F'""",
)
def g2_parse_records(spark, folder):
    """Authors from a raw layer that holds lists as text, None inside."""
    account = F.when(F.col("title") == "P", F.concat(F.lit("'"), F.col("segment"), F.lit("'"))).otherwise("None")
    text = F.concat(F.lit("[{'name': '"), F.col("writer"), F.lit("', 'socials': {'x': "), account, F.lit(", 'youtube': None}}]"))
    items = content(spark, folder).select("id", F.when(F.col("title") != "F", text).otherwise("[]").alias("authors"))
    return silver.explode_authors(silver.with_native_lists(items)).select("id", "author_name", "x")


_DIRTY = """
dirty AS (
  SELECT CASE WHEN title = 'F' THEN NULL ELSE id END AS id, content_type,
         CASE WHEN balance < 0 THEN '  ' ELSE title END AS title,
         CASE WHEN segment = 'MACHINERY' THEN NULL ELSE published_at END AS published_at,
         CASE WHEN segment = 'BUILDING' THEN published_at - INTERVAL 1 DAY ELSE updated_at END AS updated_at
  FROM content
)"""


def _dirty(spark, folder):
    """Content with gaps and contradictions in some of its rows."""
    day_before = F.col("published_at") - F.make_dt_interval(days=F.lit(1))
    return content(spark, folder).select(
        F.when(F.col("title") != "F", F.col("id")).alias("id"),
        "content_type",
        F.when(F.col("balance") < 0, "  ").otherwise(F.col("title")).alias("title"),
        F.when(F.col("segment") != "MACHINERY", F.col("published_at")).alias("published_at"),
        F.when(F.col("segment") == "BUILDING", day_before).otherwise(F.col("updated_at")).alias("updated_at"),
    )


_RULE_ARGS = (("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"), "1996-01-01", "2000-12-31")
_TESTS = {
    "id_missing": "id IS NULL",
    "type_unknown": "content_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
    "title_blank": "title IS NULL OR TRIM(title) = ''",
    "published_missing": "published_at IS NULL",
    "published_out_of_range": "published_at < TIMESTAMP '1996-01-01' OR published_at > TIMESTAMP '2000-12-31'",
    "updated_before_published": "updated_at < published_at",
}


@query(
    "v1_validation",
    with_parts(CONTENT, _DIRTY)
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {test}) AS violations, COUNT(*) AS checked FROM dirty"
        for name, test in _TESTS.items()
    ),
)
def v1_validation(spark, folder):
    return quality.validate(_dirty(spark, folder), quality.content_rules(*_RULE_ARGS))


_FAILED = " || ".join(f"CASE WHEN COALESCE({test}, FALSE) THEN '{name},' ELSE '' END" for name, test in _TESTS.items())


@query(
    "v1_quarantine",
    with_parts(CONTENT, _DIRTY)
    + f"""SELECT id, content_type, RTRIM(failed, ',') AS failed_rules FROM (SELECT *, {_FAILED} AS failed FROM dirty)
          WHERE failed <> ''""",
)
def v1_quarantine(spark, folder):
    """Rows that break a rule, with the rules they break."""
    _clean, bad = quality.quarantine(_dirty(spark, folder), quality.content_rules(*_RULE_ARGS))
    return bad.select("id", "content_type", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query(
    "v2_unknown_source",
    with_parts(CONTENT, SOURCE_DIM)
    + "SELECT id, news_site FROM content WHERE news_site NOT IN (SELECT news_site FROM source_dim)",
)
def v2_unknown_source(spark, folder):
    return quality.unknown_sources(content(spark, folder), source_dim(spark, folder)).select("id", "news_site")


@query(
    "v3_normalise",
    with_parts(CONTENT)
    + """SELECT id, CASE WHEN balance < 0 THEN NULL ELSE news_site END AS news_site,
         CASE WHEN segment = 'MACHINERY' THEN NULL ELSE strftime(published_at, '%Y-%m-%d') END AS published_on FROM content""",
)
def v3_normalise(spark, folder):
    """Padded and blank names, readable and unreadable times."""
    padded = F.when(F.col("balance") < 0, "   ").otherwise(F.concat(F.lit("  "), F.col("news_site"), F.lit(" ")))
    text = F.when(F.col("segment") == "MACHINERY", "not a date").otherwise(
        F.concat(F.lit(" "), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    raw = content(spark, folder).select("id", padded.alias("news_site"), text.alias("published_at"))
    clean = quality.normalise(raw, ("news_site",), ("published_at",))
    return clean.select("id", "news_site", F.date_format("published_at", "yyyy-MM-dd").alias("published_on"))


@query(
    "q3_mixed_precision",
    """SELECT event_type AS content_type, user_id AS id, MAX(ts) AS updated_at FROM events GROUP BY ALL""",
)
def q3_mixed_precision(spark, folder):
    """Times as text, whole seconds written without a fraction, compared as times."""
    whole = F.date_trunc("second", "ts") == F.col("ts")
    short, full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    raw = table(spark, folder, "events").select(
        F.col("event_type").alias("content_type"), F.col("user_id").alias("id"), F.when(whole, short).otherwise(full).alias("updated_at")
    )
    latest = dedup.latest_per_key(raw.withColumn("updated_at", parse_timestamp("updated_at")))
    return latest.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query(
    "v4_layer_counts",
    with_parts(CONTENT, SOURCE_DIM, FACT_SQL)
    + """SELECT 'bronze' AS layer, 'events' AS entity, COUNT(*) AS row_count FROM events
         UNION ALL SELECT 'silver', 'events', COUNT(*) FROM (SELECT DISTINCT event_type, user_id FROM events)
         UNION ALL SELECT 'gold', 'fact_article', COUNT(*) FROM fact
         UNION ALL SELECT 'gold', 'dim_news_source', COUNT(*) FROM source_dim""",
)
def v4_layer_counts(spark, folder):
    versions = _versions(spark, folder)
    return quality.layer_counts(
        {
            ("bronze", "events"): versions,
            ("silver", "events"): dedup.latest_per_key(versions),
            ("gold", "fact_article"): fact(spark, folder),
            ("gold", "dim_news_source"): source_dim(spark, folder),
        }
    )


@query(
    "v4_below_minimum",
    """SELECT * FROM (
         SELECT 'bronze' AS layer, 'events' AS entity, COUNT(*) AS row_count, (SELECT COUNT(*) FROM lineitem) AS min_count FROM events
         UNION ALL SELECT 'silver', 'reports', 0, 1) WHERE row_count < min_count""",
)
def v4_below_minimum(spark, folder):
    """A layer that is too small, one that is large enough, one that is not there."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    counts = quality.layer_counts(
        {("bronze", "events"): table(spark, folder, "events"), ("silver", "orders"): table(spark, folder, "orders")}
    )
    return quality.below_minimum(counts, {("bronze", "events"): lines, ("silver", "orders"): 1, ("silver", "reports"): 1})

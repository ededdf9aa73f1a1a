"""Upserts, dimensions, facts, and the marts over them."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from galley.functions.dates import with_date_parts
from galley.operators.conform import conform, union_all
from galley.plans import ledger, marts, star
from galley.plans.run import Layout
from galley.plans.views import VIEWS, publish_views
from galley.registry.base import (
    STAR,
    TOPIC_ROWS,
    CONTENT,
    content,
    dated_content,
    fact,
    info,
    query,
    source_dim,
    table,
    with_parts,
)
from galley.schemas import DIM_TOPIC, FACT_ARTICLE, TABLES
from galley.session import configure, materialize, scratch_path
from galley.sources.tables import ensure_table, read_table, replace_table, table_exists, upsert
from galley.plans.silver import explode_sites

_KEYS = ("content_type", "id")
_MONTHLY = ("year", "month")
_COLUMNS = ("content_type", "id", "title", "published_at", "updated_at", "year", "month")


def _stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def _first_slice(spark, folder):
    items = dated_content(spark, folder)
    return items.filter(F.col("published_at") <= _stamp("1999-06-30 00:00:00")).select(*_COLUMNS)


def _second_slice(spark, folder):
    """Overlaps the first by a year, with new titles and a publication date moved by 40 days."""
    moved = F.col("published_at") + F.make_dt_interval(days=F.lit(40))
    items = content(spark, folder).filter(F.col("published_at") > _stamp("1998-06-30 00:00:00"))
    changed = items.withColumns(
        {
            "title": F.concat(F.lit("corrected "), F.col("title")),
            "published_at": moved,
            "updated_at": F.col("updated_at") + F.make_dt_interval(days=F.lit(1)),
        }
    )
    return with_date_parts(changed, "published_at").select(*_COLUMNS)


_SLICES = """
first_slice AS (
  SELECT content_type, id, title, published_at, updated_at, year, month FROM content
  WHERE published_at <= TIMESTAMP '1999-06-30'
), second_slice AS (
  SELECT content_type, id, 'corrected ' || title AS title, published_at + INTERVAL 40 DAY AS published_at,
         updated_at + INTERVAL 1 DAY AS updated_at,
         strftime(published_at + INTERVAL 40 DAY, '%Y') AS year, strftime(published_at + INTERVAL 40 DAY, '%m') AS month
  FROM content WHERE published_at > TIMESTAMP '1998-06-30'
)"""
_MERGED = (
    with_parts(CONTENT, _SLICES)
    + """SELECT * FROM first_slice f WHERE NOT EXISTS (
           SELECT 1 FROM second_slice s WHERE s.content_type = f.content_type AND s.id = f.id)
         UNION ALL SELECT * FROM second_slice"""
)


def _merge(spark, *batches, newer_by=None):
    path = scratch_path(spark, "items")
    for batch in batches:
        upsert(batch, path, _KEYS, _MONTHLY, newer_by)
    return read_table(spark, path, batches[0].schema)


@query("k5_upsert", _MERGED)
def k5_upsert(spark, folder):
    return _merge(spark, _first_slice(spark, folder), _second_slice(spark, folder))


@query("k5_upsert_twice", _MERGED)
def k5_upsert_twice(spark, folder):
    """The second batch again: nothing changes."""
    second = _second_slice(spark, folder)
    return _merge(spark, _first_slice(spark, folder), second, second)


@query("k5_upsert_newer", _MERGED)
def k5_upsert_newer(spark, folder):
    """An old batch replayed after a newer one does not win."""
    return _merge(spark, _second_slice(spark, folder), _first_slice(spark, folder), newer_by="updated_at")


@query("k5_upsert_unchanged", _MERGED)
def k5_upsert_unchanged(spark, folder):
    """Everything merged is sent again: rows equal to the stored ones are left where they are."""
    merged = _merge(spark, _first_slice(spark, folder), _second_slice(spark, folder))
    path = scratch_path(spark, "items")
    upsert(merged.filter(F.col("month") < "07"), path, _KEYS, _MONTHLY)
    upsert(merged, path, _KEYS, _MONTHLY, skip_unchanged=True)
    return read_table(spark, path, merged.schema)


@query("k4_create_if_absent", with_parts(CONTENT) + "SELECT content_type, id, title, year, month, TRUE AS created FROM content")
def k4_create_if_absent(spark, folder):
    """An empty table made from a schema, found again, then filled."""
    items = dated_content(spark, folder).select("content_type", "id", "title", "year", "month")
    path = scratch_path(spark, "created")
    created = ensure_table(spark, path, items.schema, _MONTHLY)
    again = ensure_table(spark, path, items.schema, _MONTHLY)
    upsert(items, path, _KEYS, _MONTHLY)
    return read_table(spark, path, items.schema).withColumn("created", F.lit(created and not again))


_FACT_COLUMNS = "article_id, content_type, news_source_id, title, published_at, updated_at, year, month, day"


@query("s9_empty_fact", STAR + f"SELECT {_FACT_COLUMNS} FROM fact")
def s9_empty_fact(spark, folder):
    """A fact table that began empty takes real rows: both have the same column types."""
    path = scratch_path(spark, "fact")
    empty = star.empty_fact(spark)
    ensure_table(spark, path, empty.schema, _MONTHLY)
    upsert(star.typed_fact(fact(spark, folder)), path, ("article_id", "content_type"), _MONTHLY)
    rows = read_table(spark, path, FACT_ARTICLE)
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("published_at", "updated_at")})


@query(
    "d1_dim_source_initial",
    """SELECT ROW_NUMBER() OVER (ORDER BY news_site) AS news_source_id, news_site, '4.' || top || '.0' AS version FROM (
         SELECT news_site, MAX(s_suppkey) AS top FROM (
           SELECT n_name AS news_site, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
           UNION ALL SELECT s_name, s_suppkey FROM supplier) GROUP BY news_site)""",
)
def d1_dim_source_initial(spark, folder):
    """Every site once, with its highest version, numbered by name."""
    return star.build_source_dim(explode_sites(info(spark, folder)))


@query(
    "d1_dim_source_incremental",
    """WITH listed AS (SELECT c_name AS news_site, c_nationkey AS v, c_mktsegment FROM customer),
       current_dim AS (SELECT ROW_NUMBER() OVER (ORDER BY news_site) AS news_source_id, news_site
                       FROM listed WHERE c_mktsegment <> 'BUILDING')
       SELECT news_source_id, news_site, '4.' || v || '.0' AS version FROM current_dim JOIN listed USING (news_site)
       UNION ALL
       SELECT (SELECT COALESCE(MAX(news_source_id), 0) FROM current_dim) + ROW_NUMBER() OVER (ORDER BY news_site),
              news_site, '4.' || v || '.0'
       FROM listed WHERE news_site NOT IN (SELECT news_site FROM current_dim)""",
)
def d1_dim_source_incremental(spark, folder):
    """Customers as sites: those of all segments but one are known already."""
    listed = table(spark, folder, "customer").select(
        F.col("c_name").alias("news_site"),
        F.concat(F.lit("4."), F.col("c_nationkey"), F.lit(".0")).alias("version"),
        "c_mktsegment",
    )
    current = star.build_source_dim(listed.filter(F.col("c_mktsegment") != "BUILDING"))
    return star.build_source_dim(listed, current)


@query(
    "d2_dim_topic",
    """SELECT DISTINCT o_orderpriority AS topic_id,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
                                   WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS topic_name
       FROM orders""",
)
def d2_dim_topic(spark, folder):
    """Constant topics upserted over the types found in the data, which stand under their own name."""
    found = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("topic_id")).distinct()
    path = scratch_path(spark, "dim_topic")
    upsert(found.withColumn("topic_name", F.col("topic_id")), path, ("topic_id",))
    upsert(star.build_topic_dim(spark, TOPIC_ROWS), path, ("topic_id",))
    return read_table(spark, path, DIM_TOPIC)


def _topics(spark):
    return star.build_topic_dim(spark, TOPIC_ROWS)


@query("f1_fact", STAR + f"SELECT {_FACT_COLUMNS} FROM fact")
def f1_fact(spark, folder):
    return fact(spark, folder)


@query("m1_by_month", STAR + "SELECT year, month, COUNT(*) AS article_count FROM fact GROUP BY ALL")
def m1_by_month(spark, folder):
    return marts.by_month(fact(spark, folder))


_BY_SOURCE = """by_source AS (
  SELECT news_site, year, month, COUNT(*) AS article_count FROM fact LEFT JOIN source_dim USING (news_source_id) GROUP BY ALL)"""


@query("m2_by_source_month", STAR.rstrip() + "," + _BY_SOURCE + " SELECT * FROM by_source")
def m2_by_source_month(spark, folder):
    return marts.by_source_month(fact(spark, folder), source_dim(spark, folder))


@query("m3_by_type_month", STAR + "SELECT content_type, year, month, COUNT(*) AS article_count FROM fact GROUP BY ALL")
def m3_by_type_month(spark, folder):
    return marts.by_type_month(fact(spark, folder))


_NAMED = "FROM fact LEFT JOIN source_dim USING (news_source_id) LEFT JOIN topic_dim ON content_type = topic_id"


@query(
    "m4_detail",
    STAR
    + f"SELECT article_id, content_type, news_source_id, news_site, topic_id, topic_name, title, published_at, updated_at, year, month, day {_NAMED}",
)
def m4_detail(spark, folder):
    return marts.detail(fact(spark, folder), source_dim(spark, folder), _topics(spark))


_RECENT = STAR + f"SELECT article_id, content_type, news_site, topic_name, title, published_at {_NAMED}"


@query("m5_recent_items", _RECENT + " ORDER BY published_at DESC, article_id, content_type LIMIT 100")
def m5_recent_items(spark, folder):
    return marts.recent_items(fact(spark, folder), source_dim(spark, folder), _topics(spark), 100)


@query("m5_recent_view", _RECENT)
def m5_recent_view(spark, folder):
    """The listing view itself, without order or limit."""
    return marts.recent_items(fact(spark, folder), source_dim(spark, folder), _topics(spark))


@query(
    "m6_topic_trend",
    STAR
    + """SELECT topic_name, year, month, article_count FROM (
           SELECT content_type, year, month, COUNT(*) AS article_count FROM fact GROUP BY ALL)
         LEFT JOIN topic_dim ON content_type = topic_id
         ORDER BY year DESC, month DESC, article_count DESC, content_type LIMIT 50""",
)
def m6_topic_trend(spark, folder):
    return marts.topic_trend(fact(spark, folder), _topics(spark))


@query(
    "m7_top_sources",
    STAR.rstrip()
    + ","
    + _BY_SOURCE
    + """ SELECT news_site, CAST(SUM(article_count) AS BIGINT) AS total_publications FROM by_source
          WHERE news_site IS NOT NULL GROUP BY news_site ORDER BY total_publications DESC, news_site LIMIT 20""",
)
def m7_top_sources(spark, folder):
    return marts.top_sources(fact(spark, folder), source_dim(spark, folder))


@query(
    "m8_recent_sources",
    STAR.rstrip()
    + ","
    + _BY_SOURCE
    + """ SELECT * FROM by_source WHERE news_site IS NOT NULL
          ORDER BY year DESC, month DESC, article_count DESC, news_site LIMIT 30""",
)
def m8_recent_sources(spark, folder):
    return marts.recent_sources(fact(spark, folder), source_dim(spark, folder))


@query(
    "c5_topic_daily",
    STAR
    + """SELECT content_type, topic_name, year, month, day, article_count FROM (
           SELECT content_type, year, month, day, COUNT(*) AS article_count FROM fact GROUP BY ALL)
         LEFT JOIN topic_dim ON content_type = topic_id""",
)
def c5_topic_daily(spark, folder):
    """Topic counts per day, stored by month and read back."""
    daily = marts.by_topic_period(fact(spark, folder), _topics(spark), marts.DAY)
    path = scratch_path(spark, "agg_topic_day")
    replace_table(daily, path, _MONTHLY)
    return read_table(spark, path, daily.schema).select(*daily.columns)


@query("c5_source_monthly", STAR.rstrip() + "," + _BY_SOURCE + " SELECT * FROM by_source")
def c5_source_monthly(spark, folder):
    """Source counts per month, stored; the group without a source is kept."""
    monthly = marts.by_source_month(fact(spark, folder), source_dim(spark, folder))
    path = scratch_path(spark, "agg_source_month")
    replace_table(monthly, path, _MONTHLY)
    return read_table(spark, path, monthly.schema).select(*monthly.columns)


@query(
    "c5_topic_monthly",
    STAR
    + """SELECT content_type, topic_name, year, month, article_count FROM (
           SELECT content_type, year, month, COUNT(*) AS article_count FROM fact GROUP BY ALL)
         LEFT JOIN topic_dim ON content_type = topic_id""",
)
def c5_topic_monthly(spark, folder):
    """Topic counts per month, stored; one year is then counted again and replaced alone."""
    facts, path = fact(spark, folder), scratch_path(spark, "agg_topic_month")
    monthly = marts.by_topic_period(facts, _topics(spark), marts.MONTH)
    replace_table(monthly, path, _MONTHLY)
    again = facts.filter(F.col("year") == "1996")
    months = [(r["year"], r["month"]) for r in again.select("year", "month").distinct().collect()]
    replace_table(marts.by_topic_period(again, _topics(spark), marts.MONTH), path, _MONTHLY, months)
    return read_table(spark, path, monthly.schema).select(*monthly.columns)


@query(
    "c5_source_daily",
    STAR
    + """SELECT news_site, year, month, day, COUNT(*) AS article_count
         FROM fact LEFT JOIN source_dim USING (news_source_id) GROUP BY ALL""",
)
def c5_source_daily(spark, folder):
    """Source counts per day, stored by month."""
    daily = marts.by_source_period(fact(spark, folder), source_dim(spark, folder), marts.DAY)
    path = scratch_path(spark, "agg_source_day")
    replace_table(daily, path, _MONTHLY)
    return read_table(spark, path, daily.schema).select(*daily.columns)


@query("c5_monthly", STAR + "SELECT year, month, COUNT(*) AS article_count FROM fact GROUP BY ALL")
def c5_monthly(spark, folder):
    """Totals per month, stored."""
    monthly = marts.by_month(fact(spark, folder))
    path = scratch_path(spark, "agg_month")
    replace_table(monthly, path, _MONTHLY)
    return read_table(spark, path, monthly.schema).select(*monthly.columns)


_CHANGED = with_parts(CONTENT, _SLICES) + """, merged AS (
      SELECT content_type, id, year, month FROM first_slice f WHERE NOT EXISTS (
        SELECT 1 FROM second_slice s WHERE s.content_type = f.content_type AND s.id = f.id)
      UNION ALL SELECT content_type, id, year, month FROM second_slice)
    """


@query("c5_by_changes", _CHANGED + "SELECT content_type, year, month, COUNT(*) AS article_count FROM merged GROUP BY ALL")
def c5_by_changes(spark, folder):
    """Counts per type and month, kept up by the changes that an upsert tells while rows move month."""
    path, kept = scratch_path(spark, "items"), scratch_path(spark, "counts")
    for batch in (_first_slice(spark, folder), _second_slice(spark, folder)):
        done = upsert(batch, path, _KEYS, _MONTHLY, count_by=("content_type", *_MONTHLY))
        gained = marts.by_type_month(done.changes)
        stored = read_table(spark, kept, gained.schema) if table_exists(spark, kept) else gained.limit(0)
        replace_table(materialize(marts.with_changes(stored, gained), "counts"), kept, _MONTHLY)
    return read_table(spark, kept, gained.schema).select(*gained.columns)


@query(
    "k10_stored_views",
    STAR
    + """, detail AS (
      SELECT f.*, news_site, topic_name FROM fact f LEFT JOIN source_dim d ON d.news_source_id = f.news_source_id
        LEFT JOIN topic_dim ON content_type = topic_id)
    SELECT 'agg_articles_by_month' AS view, NULL AS name, year, month, COUNT(*) AS article_count FROM detail GROUP BY ALL
    UNION ALL SELECT 'agg_articles_by_source_month', news_site, year, month, COUNT(*) FROM detail GROUP BY ALL
    UNION ALL SELECT 'v_agg_articles_by_content_type_month', content_type, year, month, COUNT(*) FROM detail GROUP BY ALL
    UNION ALL SELECT 'v_fact_article_detail', topic_name, year, month, COUNT(*) FROM detail GROUP BY ALL
    UNION ALL SELECT 'v_articles_recent', news_site, year, month, COUNT(*) FROM detail GROUP BY ALL""",
)
def k10_stored_views(spark, folder):
    """The star stored, the five views published, and all of them read by another session of the catalog."""
    root, namespace = scratch_path(spark, "gold"), f"marts_{uuid.uuid4().hex[:12]}"
    layout = Layout(bronze=f"{root}/b", silver=f"{root}/s", gold=root)
    facts = conform(fact(spark, folder).withColumn("published_at", F.col("published_at").cast("timestamp")), FACT_ARTICLE)
    for name, df in (("fact_article", facts), ("dim_news_source", source_dim(spark, folder)), ("dim_topic", _topics(spark))):
        replace_table(conform(df, TABLES[name].schema), layout.table(name), TABLES[name].partition_cols)
    spark.sql(f"CREATE NAMESPACE {namespace} LOCATION '{root}/views'")
    publish_views(spark, layout, namespace)
    other = configure(spark.newSession())
    seen = {view: other.table(f"{namespace}.{view}") for view in VIEWS}
    stamp = F.col("published_at")
    dated = with_date_parts(seen["v_articles_recent"], "published_at")
    named = {
        "agg_articles_by_month": seen["agg_articles_by_month"].withColumn("name", F.lit(None).cast("string")),
        "agg_articles_by_source_month": seen["agg_articles_by_source_month"].withColumnRenamed("news_site", "name"),
        "v_agg_articles_by_content_type_month": seen["v_agg_articles_by_content_type_month"].withColumnRenamed("content_type", "name"),
        "v_fact_article_detail": seen["v_fact_article_detail"].groupBy(F.col("topic_name").alias("name"), "year", "month").agg(F.count("*").alias("article_count")),
        "v_articles_recent": dated.filter(stamp.isNotNull()).groupBy(F.col("news_site").alias("name"), "year", "month").agg(F.count("*").alias("article_count")),
    }
    return union_all([df.select(F.lit(view).alias("view"), "name", "year", "month", "article_count") for view, df in named.items()])


@query(
    "v4_run_history",
    with_parts(CONTENT)
    + """, loads AS (SELECT year AS run_id, content_type, COUNT(*) AS n FROM content GROUP BY ALL),
    stored AS (SELECT run_id, 'load' AS phase, content_type AS metric, n AS value FROM loads
               UNION ALL SELECT run_id, 'stored', 'rows', CAST(SUM(SUM(n)) OVER (ORDER BY run_id) AS BIGINT) FROM loads GROUP BY run_id)
    SELECT run_id, phase, metric, value, LAG(value) OVER w AS previous, value - LAG(value) OVER w AS change
    FROM stored WINDOW w AS (PARTITION BY phase, metric ORDER BY run_id)""",
)
def v4_run_history(spark, folder):
    """A run for each year of content: what it loaded of each type and what is stored after it, beside the run before."""
    items, path = dated_content(spark, folder), scratch_path(spark, "run_log")
    loads = items.groupBy("year", "content_type").count().orderBy("year").collect()  # a row for each year and type
    stored = 0
    for year in sorted({r["year"] for r in loads}):
        loaded = {r["content_type"]: r["count"] for r in loads if r["year"] == year}
        stored += sum(loaded.values())
        numbers = ledger.metrics({"load": loaded, "stored": {"rows": stored}})
        ledger.record(spark, path, year, numbers, at=dt.datetime(int(year), 12, 31, tzinfo=dt.timezone.utc))
    return ledger.history(spark, path).select("run_id", "phase", "metric", "value", "previous", "change")


@query(
    "k5_upsert_schema",
    with_parts(CONTENT, _SLICES)
    + """SELECT f.*, NULL AS note FROM first_slice f WHERE NOT EXISTS (
           SELECT 1 FROM second_slice s WHERE s.content_type = f.content_type AND s.id = f.id)
         UNION ALL SELECT s.*, CASE WHEN f.id IS NOT NULL THEN 'seen ' ELSE 'new ' END || s.id FROM second_slice s
           LEFT JOIN first_slice f ON s.content_type = f.content_type AND s.id = f.id""",
)
def k5_upsert_schema(spark, folder):
    """The second slice brings one column more; then it comes again without that column, and nothing is erased."""
    first, second = _first_slice(spark, folder), _second_slice(spark, folder)
    seen = second.join(first.select(*_KEYS).withColumn("_seen", F.lit(True)), list(_KEYS), "left")
    note = F.concat(F.when(F.col("_seen"), "seen ").otherwise("new "), F.col("id").cast("string"))
    wide = seen.select(*_COLUMNS, note.alias("note"))
    path = scratch_path(spark, "items")
    upsert(first, path, _KEYS, _MONTHLY)
    upsert(wide, path, _KEYS, _MONTHLY)
    upsert(second, path, _KEYS, _MONTHLY, missing="keep")
    return read_table(spark, path, wide.schema)


@query("q9_replay_old_day", _MERGED)
def q9_replay_old_day(spark, folder):
    """Both days are loaded, then the first day runs again: what it holds in older versions stays out."""
    first = _first_slice(spark, folder)
    path = scratch_path(spark, "items")
    for batch in (first, _second_slice(spark, folder), first):
        upsert(batch, path, _KEYS, _MONTHLY, newer_by="updated_at")
    return read_table(spark, path, first.schema)

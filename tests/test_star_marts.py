import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from galley.plans import marts, star
from galley.schemas import DIM_NEWS_SOURCE, DIM_TOPIC, FACT_ARTICLE

INFO = "news_site string, version string"


def _dim(spark, *names):
    return star.build_source_dim(spark.createDataFrame([(n, "4.1.0") for n in names], INFO))


def test_sites_are_listed_once_with_their_highest_version(spark):
    data = [("A", "4.9.0"), ("A", "4.29.0"), ("", "4.1.0"), (None, "4.1.0"), ("B", None)]
    assert rows(star.listed_sites(spark.createDataFrame(data, INFO))) == [("A", "4.29.0"), ("B", None)]


def test_ids_do_not_depend_on_the_layout_of_the_input(spark):
    names = [(f"s{i:03d}", "4.1.0") for i in range(200)]
    for parts in (1, 5):
        dim = star.build_source_dim(spark.createDataFrame(names, INFO).repartition(parts))
        assert rows(dim, "news_source_id", "news_site") == sorted(((i + 1, n) for i, (n, _) in enumerate(names)), key=repr)


def test_known_sites_keep_their_id_and_new_ones_follow_without_gaps(spark):
    current = spark.createDataFrame([(1, "a", "4.1.0"), (2, "b", "4.1.0"), (3, "c", "4.1.0")], DIM_NEWS_SOURCE)
    batch = star.build_source_dim(spark.createDataFrame([("b", "4.2.0"), ("d", "4.2.0"), ("aa", "4.2.0")], INFO), current)
    assert rows(batch) == [(2, "b", "4.2.0"), (4, "aa", "4.2.0"), (5, "d", "4.2.0")]


def test_empty_current_dimension_and_no_sites(spark):
    assert rows(star.build_source_dim(spark.createDataFrame([("x", "1")], INFO), star.empty_source_dim(spark)), "news_source_id") == [(1,)]
    assert star.build_source_dim(spark.createDataFrame([], INFO)).count() == 0


def test_topics_and_empty_shapes(spark):
    topics = star.build_topic_dim(spark)
    assert rows(topics) == [("article", "Article"), ("blog", "Blog"), ("report", "Report")]
    assert topics.dtypes == spark.createDataFrame([], DIM_TOPIC).dtypes
    assert star.empty_fact(spark).dtypes == spark.createDataFrame([], FACT_ARTICLE).dtypes


@pytest.fixture
def schema(spark):
    data = []
    for i in range(60):
        site = ["A", "B", "Nowhere", None][i % 4]
        month = 1 + i % 3
        kind = ["article", "blog", "video"][i % 3]
        when = dt.datetime(2024, month, 1 + i % 20)
        data.append((i, kind, site, f"t{i}", when, when, "2024", f"{month:02d}", f"{when.day:02d}"))
    columns = "id long, content_type string, news_site string, title string, published_at timestamp, updated_at timestamp, year string, month string, day string"
    content = spark.createDataFrame(data, columns)
    dim = _dim(spark, "A", "B")
    return star.build_fact(content, dim), dim, star.build_topic_dim(spark), data


def test_fact_keeps_items_without_a_known_source(spark, schema):
    fact, dim, _topics, data = schema
    assert fact.columns == [f.name for f in FACT_ARTICLE.fields]
    assert fact.count() == len(data)
    assert fact.filter("news_source_id IS NULL").count() == 30
    bare = star.build_fact(spark.createDataFrame([(1, "blog", "t", None, None, "2024", "01", "01")], "id long, content_type string, title string, published_at timestamp, updated_at timestamp, year string, month string, day string"), dim)
    assert bare.first()["news_source_id"] is None


def test_marts_agree_on_the_total(schema):
    fact, dim, _topics, data = schema
    total = [
        mart.agg(F.sum("article_count")).first()[0]
        for mart in (marts.by_month(fact), marts.by_type_month(fact), marts.by_source_month(fact, dim), marts.by_source_period(fact, dim, marts.DAY))
    ]
    assert total == [len(data)] * 4


def test_unknown_source_is_a_group_of_its_own_and_no_ranked_source(schema):
    fact, dim, topics, _ = schema
    assert marts.by_source_month(fact, dim).filter("news_site IS NULL").agg(F.sum("article_count")).first()[0] == 30
    assert [tuple(r) for r in marts.top_sources(fact, dim).collect()] == [("A", 15), ("B", 15)]
    recent = marts.recent_sources(fact, dim, 3).collect()
    assert [(r["month"], r["article_count"], r["news_site"]) for r in recent] == [("03", 5, "A"), ("03", 5, "B"), ("02", 5, "A")]


def test_topic_trend_keeps_types_without_topic(schema):
    fact, _dim, topics, _ = schema
    got = [tuple(r) for r in marts.topic_trend(fact, topics, 2).collect()]
    assert got == [(None, "2024", "03", 20), ("Blog", "2024", "02", 20)]


def test_recent_items(schema):
    fact, dim, topics, data = schema
    newest = sorted(data, key=lambda d: (-d[4].timestamp(), d[0], d[1]))[:7]
    got = marts.recent_items(fact, dim, topics, 7).collect()
    assert [r["article_id"] for r in got] == [d[0] for d in newest]
    assert marts.recent_items(fact, dim, topics).count() == len(data)


def test_views(spark, schema):
    fact, dim, topics, data = schema
    marts.register_views(fact, dim, topics)
    assert spark.sql("SELECT SUM(article_count) FROM agg_articles_by_month").first()[0] == len(data)
    assert spark.sql("SELECT COUNT(*) FROM v_fact_article_detail WHERE topic_name IS NULL").first()[0] == 20
    assert spark.sql("SELECT * FROM v_articles_recent ORDER BY published_at DESC LIMIT 3").count() == 3


def test_plans(spark, schema, plan, tmp_path):
    fact, dim, topics, _ = schema
    fact.write.parquet(f"{tmp_path}/fact")
    dim.write.parquet(f"{tmp_path}/dim")
    stored = spark.read.schema(fact.schema).parquet(f"{tmp_path}/fact")
    dim = spark.read.schema(dim.schema).parquet(f"{tmp_path}/dim")
    top = plan(marts.top_sources(stored, dim))
    assert "TakeOrderedAndProject" in top
    # Facts are reduced before the dimension is met: the join lies above a partial count.
    assert top.index("Join") < top.index("partial_count(1)")
    detail = plan(marts.detail(stored, dim, topics))
    assert detail.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in detail
    content = stored.withColumn("news_site", F.col("title")).withColumnRenamed("article_id", "id").drop("news_source_id")
    assert "BroadcastHashJoin" in plan(star.build_fact(content, dim))
    monthly = plan(marts.by_month(stored))
    assert "ReadSchema: struct<year:string,month:string>" in monthly

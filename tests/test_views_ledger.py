import datetime as dt
import json

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_sources import item, land, page

from galley.plans import ledger
from galley.plans.run import Layout, parse_minimum, run, stored
from galley.plans.views import VIEWS, publish_views
from galley.schemas import RUN_LOG
from galley.sources import bronze
from galley.sources.tables import read_table
from galley.streaming import landed_stream


@pytest.fixture
def layout(tmp_path):
    return Layout(*(f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold", "landing", "quarantine")))


def day(spark, layout, tmp_path, name, date, *items, sites=("A",), **options):
    land(tmp_path / name, "articles", page(*items, last=True, count=len(items)))
    land(tmp_path / name, "info", {"version": "4.9.0", "news_sites": list(sites)})
    where = Layout(layout.bronze, layout.silver, layout.gold, str(tmp_path / name), layout.quarantine)
    return run(spark, where, options.pop("phases", "ingest,silver,dims,facts"), ingestion_date=date, **options)


def log_of(spark, layout):
    return read_table(spark, layout.table("run_log"), RUN_LOG)


def test_a_second_session_reads_the_views_with_what_is_stored_by_then(spark, layout, tmp_path):
    day(spark, layout, tmp_path, "one", "2024-04-01", item(1, news_site="A"), item(2, news_site="Nowhere"))
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS views_test LOCATION '{tmp_path}/views'")
    for _ in range(2):
        assert publish_views(spark, layout, "views_test") == [f"views_test.{v}" for v in VIEWS]
    other = spark.newSession()
    assert rows(other.table("views_test.agg_articles_by_month")) == [("2024", "01", 2)]
    assert rows(other.table("views_test.agg_articles_by_source_month")) == sorted([("A", "2024", "01", 1), (None, "2024", "01", 1)], key=repr)
    day(spark, layout, tmp_path, "two", "2024-04-02", item(3, news_site="A", published_at="2024-02-02T00:00:00Z", updated_at="2024-02-03T00:00:00Z"))
    assert stored(spark, layout, "fact_article").count() == 3
    again = spark.newSession()
    assert rows(again.table("views_test.v_agg_articles_by_content_type_month")) == [("article", "2024", "01", 2), ("article", "2024", "02", 1)]
    assert rows(again.table("views_test.v_fact_article_detail"), "article_id", "news_site", "topic_name") == sorted(
        [(1, "A", "Article"), (2, None, "Article"), (3, "A", "Article")], key=repr
    )
    assert again.table("views_test.v_articles_recent").orderBy(F.desc("published_at")).first()["article_id"] == 3


def test_runs_are_recorded_and_compared(spark, layout, tmp_path):
    done = day(spark, layout, tmp_path, "one", "2024-04-01", item(1, news_site="A"), item(2, news_site="Nowhere"))
    assert done["unknown_sources"] == {"items": 1}
    day(spark, layout, tmp_path, "two", "2024-04-02", item(3, news_site="A"))
    found = ledger.history(spark, layout.table("run_log"))
    fetched = found.filter("phase = 'ingest' and metric = 'fetched'").orderBy("run_at").collect()
    assert [(r["status"], r["value"], r["previous"], r["change"]) for r in fetched] == [("marked", 3, None, None), ("ok", 2, 3, -1)]
    assert found.filter("metric = 'articles.batch_rows'").count() == 2


def test_a_run_below_a_minimum_fails_and_is_recorded(spark, layout, tmp_path):
    least = {("silver", "articles"): 3, ("silver", "reports"): 0, ("gold", "nothing"): 1}
    with pytest.raises(ledger.GateFailed, match="silver.articles"):
        day(spark, layout, tmp_path, "one", "2024-04-01", item(1, news_site="A"), minimum=least)
    assert rows(log_of(spark, layout).filter("phase = 'below_minimum'"), "status", "metric", "value") == [
        ("stopped", "gold.nothing", 0), ("stopped", "silver.articles", 1),
    ]
    more = [item(i, news_site="A") for i in (2, 3)]
    day(spark, layout, tmp_path, "two", "2024-04-02", *more, minimum={("silver", "articles"): 3})
    assert parse_minimum(["silver.articles=3"]) == {("silver", "articles"): 3}
    for bad in ("silver=3", "silver.articles", "silver.articles=x"):
        with pytest.raises(ValueError):
            parse_minimum([bad])


def test_unknown_sources_may_stop_a_run_before_its_facts(spark, layout, tmp_path):
    with pytest.raises(ledger.GateFailed, match="1 items"):
        day(spark, layout, tmp_path, "one", "2024-04-01", item(1, news_site="Nowhere"), unknown_sources="stop")
    assert stored(spark, layout, "fact_article").count() == 0 and rows(log_of(spark, layout).select("status").distinct()) == [("stopped",)]
    day(spark, layout, tmp_path, "two", "2024-04-02", item(2, news_site="Nowhere"), unknown_sources="ignore")
    with pytest.raises(ValueError):
        run(spark, layout, "dims", unknown_sources="perhaps")


def test_a_phase_that_breaks_is_recorded(spark, layout):
    with pytest.raises(Exception):
        run(spark, Layout(layout.bronze, layout.silver, layout.gold, "/nowhere/at/all"), "ingest", ingestion_date="2024-04-01")
    assert rows(log_of(spark, layout), "status", "metric") == [("failed", None)]


def test_numbers_of_a_run():
    assert ledger.metrics({"a": {"x": 1, "y": {"z": 2}}, "b": 3, "c": None, "d": True}) == [("a", "x", 1), ("a", "y.z", 2), ("b", "", 3), ("d", "", 1)]
    assert dt.timezone.utc


def test_a_raw_layer_with_lists_as_text_goes_through_the_flow(spark, layout):
    old = spark.createDataFrame(
        [(1, "article", "t", "A", "2024-01-02T00:00:00Z", "2024-01-02T00:00:00Z", "[{'name': \"O'Neil\", 'socials': None}]", "[]", None)],
        "id long, content_type string, title string, news_site string, published_at string, updated_at string, authors string, launches string, events string",
    )
    record = spark.createDataFrame([(0, "info", "4.9.0", "['A', \"B's\"]")], "id long, content_type string, version string, news_sites string")
    for df in (old, record):
        bronze.append_partitioned(bronze.with_date_parts(df, ("2024", "04", "01")), layout.bronze)
    run(spark, layout, "silver,dims", ingestion_date="2024-04-01", raw_lists="text")
    assert rows(stored(spark, layout, "articles"), "id", F.col("authors")[0]["name"]) == [(1, "O'Neil")]
    assert {r["news_site"] for r in stored(spark, layout, "dim_news_source").collect()} == {"A", "B's"}


def test_versions_seen_before_cause_no_upsert(spark, layout, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    calls = []
    real = landed_stream.store
    monkeypatch.setattr(landed_stream, "store", lambda df, where, name, **o: calls.append((name, df.count())) or real(df, where, name, **o))

    def load(file, *items):
        target = landing / "endpoint=articles"
        target.mkdir(parents=True, exist_ok=True)
        (target / file).write_text(json.dumps(page(*items, last=True)))
        stream = landed_stream.stream_items(spark, str(landing))
        landed_stream.upsert_stream(stream, layout, "2024-04-01", f"{tmp_path}/checkpoint").awaitTermination()
        out, calls[:] = list(calls), []
        return out

    first = item(1, published_at="2020-01-02T00:00:00Z", updated_at=None)
    assert load("a.json", first, item(2)) == [("articles", 2)]
    assert load("b.json", item(9, title="before"), first, item(2)) == [("articles", 1)]
    assert load("c.json", first, item(2)) == []
    assert load("d.json", item(2, title="corrected"), item(2)) == [("articles", 1)]
    assert rows(stored(spark, layout, "articles"), "id", "title") == [(1, "t1"), (2, "corrected"), (9, "before")]

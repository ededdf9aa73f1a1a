import json

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_sources import item, land, page

from galley.plans import run as flow
from galley.plans.run import Layout, parse_phases, run, stored
from galley.session import scratch_root
from galley.sources import bronze, files
from galley.streaming.landed_stream import stream_items, upsert_stream


@pytest.fixture
def layout(tmp_path):
    return Layout(*(f"{tmp_path}/{n}" for n in ("bronze", "silver", "gold", "landing", "quarantine")))


def _land_first_day(tmp_path):
    old = {"published_at": "2024-01-02T03:04:05Z", "updated_at": "2024-01-02T03:04:05Z"}
    new = {"published_at": "2024-01-02T03:04:05Z", "updated_at": "2024-01-02T03:04:05.9Z", "title": "newer"}
    landing = tmp_path / "landing"
    land(landing, "articles", page(item(1, news_site="A", summary="NASA crew launch", **old), item(2, news_site="B's", **old)), page(item(3, news_site="Nowhere", **old), item(1, **old), offset=2, last=True))
    land(landing, "blogs", page(item(1, news_site="A", published_at="2024-02-03T00:00:00Z", updated_at=None), last=True))
    land(landing, "reports", page({"id": 7, "title": "r", "published_at": "2024-03-01T00:00:00Z", "updated_at": "2024-03-01T00:00:00Z"}, last=True))
    land(landing, "info", {"version": "4.9.0", "news_sites": ["A", "B's"]})
    return new


def test_phases():
    assert parse_phases("facts, dims") == ("dims", "facts")
    assert parse_phases("aggregates") == ("aggregates",)
    with pytest.raises(ValueError, match="unknown phases"):
        parse_phases("dims,fact")


@pytest.mark.parametrize("phases, missing", [("silver", "ingestion_date"), ("content", "gazetteer")])
def test_missing_arguments(spark, layout, phases, missing):
    with pytest.raises(ValueError, match=missing):
        run(spark, layout, phases)


def test_whole_flow_twice_and_an_update(spark, layout, tmp_path):
    new = _land_first_day(tmp_path)
    gazetteer = spark.createDataFrame([("NASA", "company")], "entity string, kind string")
    rules = spark.createDataFrame([("people", "crew", 1)], "topic string, term string, weight long")
    options = {"ingestion_date": "2024-04-01", "gazetteer": gazetteer, "rules": rules}
    everything = "ingest,silver,content,dims,facts,aggregates"
    done = run(spark, layout, everything, **options)
    assert done["ingest"] == {"fetched": 7, "deduped": 6, "written": 6}

    def snapshot():
        tables = ("articles", "blogs", "reports", "info", "enriched", "dim_news_source", "dim_topic", "fact_article", "agg_topic_day", "agg_source_month")
        return {t: rows(stored(spark, layout, t)) for t in tables}

    first = snapshot()
    counts = {(r["layer"], r["entity"]): r["row_count"] for r in flow.counts(spark, layout).collect()}
    assert counts[("gold", "fact_article")] == sum(counts[("silver", t)] for t in ("articles", "blogs", "reports")) == 5
    assert counts[("silver", "info")] == counts[("gold", "dim_news_source")] == 2 and counts[("gold", "dim_topic")] == 3
    facts = stored(spark, layout, "fact_article")
    assert rows(facts, "article_id", "content_type", "news_source_id", "year", "month", "day") == [
        (1, "article", 1, "2024", "01", "02"), (1, "blog", 1, "2024", "02", "03"), (2, "article", 2, "2024", "01", "02"),
        (3, "article", None, "2024", "01", "02"), (7, "report", None, "2024", "03", "01"),
    ]
    assert rows(stored(spark, layout, "enriched").filter("topic <> 'other'"), "id", F.col("entities")[0]["entity"]) == [(1, "NASA")]
    assert rows(stored(spark, layout, "agg_source_month").filter("news_site IS NULL"), "month", "article_count") == [("01", 1), ("03", 1)]

    run(spark, layout, everything.replace("ingest,", ""), **options)
    assert snapshot() == first

    land(tmp_path / "day2", "articles", page(item(1, news_site="A", **new), item(9, news_site="C"), last=True))
    land(tmp_path / "day2", "info", {"version": "4.29.0", "news_sites": ["C", "A"]})
    second = Layout(layout.bronze, layout.silver, layout.gold, str(tmp_path / "day2"))
    run(spark, second, "ingest,silver,dims,facts", ingestion_date="2024-04-02")
    assert rows(stored(spark, layout, "articles"), "id", "title", "ingestion_day") == [(1, "newer", "02"), (2, "t2", "01"), (3, "t3", "01"), (9, "t9", "02")]
    assert rows(stored(spark, layout, "dim_news_source")) == [(1, "A", "4.29.0"), (2, "B's", "4.9.0"), (3, "C", "4.29.0")]
    assert stored(spark, layout, "fact_article").count() == 6


def test_bad_rows_go_to_quarantine(spark, layout, tmp_path):
    land(tmp_path / "landing", "articles", page(item(1), item(2, published_at="never"), last=True))
    land(tmp_path / "landing", "info", {"version": "4.9.0", "news_sites": []})
    run(spark, layout, "ingest,silver", ingestion_date="2024-04-01")
    assert rows(stored(spark, layout, "articles"), "id") == [(1,)]
    bad = spark.read.parquet(f"{layout.quarantine}/ingestion_date=2024-04-01")
    assert rows(bad, "id", "failed_rules") == [(2, ["published_missing"])]


def test_gold_from_nothing_still_makes_its_tables(spark, layout):
    run(spark, layout, "dims,facts,aggregates")
    for name in ("dim_news_source", "dim_topic", "fact_article", "agg_topic_day"):
        assert files.exists(spark, layout.table(name))
    assert stored(spark, layout, "fact_article").count() == 0


def test_silver_of_a_day_never_loaded(spark, layout):
    run(spark, layout, "silver", ingestion_date="2024-04-01")
    assert stored(spark, layout, "articles").count() == 0


def test_landing_with_no_items(spark, layout, tmp_path):
    land(tmp_path / "landing", "articles", page(count=0, last=True))
    land(tmp_path / "landing", "info", {"version": "4.9.0", "news_sites": []})
    assert run(spark, layout, "ingest", ingestion_date="2024-04-01")["ingest"] == {"fetched": 1, "deduped": 1, "written": 1}


def test_cap_per_type(spark, layout, tmp_path):
    _land_first_day(tmp_path)
    done = run(spark, layout, "ingest", ingestion_date="2024-04-01", max_items="1")
    assert done["ingest"]["written"] == 4
    assert rows(bronze.read_bronze(spark, layout.bronze).filter("content_type = 'article'"), "id") == [(1,)]


def test_facts_of_one_publication_day(spark, layout, tmp_path):
    _land_first_day(tmp_path)
    run(spark, layout, "ingest,silver,dims,facts", ingestion_date="2024-04-01", published_date="2024-02-03")
    assert rows(stored(spark, layout, "fact_article"), "article_id", "content_type") == [(1, "blog")]


def test_catalog_names(tmp_path):
    layout = Layout("s3://b/bronze", "lake.silver", "lake.gold")
    assert layout.table("articles") == "lake.silver.articles" and layout.table("fact_article") == "lake.gold.fact_article"


def test_stream_loads_what_landed_and_ignores_late_old_versions(spark, layout, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "articles", page(item(1, title="v2", updated_at="2024-01-02T05:00:00Z"), item(2), last=True))

    def load():
        upsert_stream(stream_items(spark, str(landing)), layout, "2024-04-01", f"{tmp_path}/checkpoint").awaitTermination()
        return rows(stored(spark, layout, "articles"), "id", "title")

    assert load() == [(1, "v2"), (2, "t2")]
    late = landing / "endpoint=articles" / "late.json"
    late.write_text(json.dumps(page(item(1, title="v1", updated_at="2024-01-02T04:00:00Z"), item(3), last=True)))
    assert load() == [(1, "v2"), (2, "t2"), (3, "t3")]
    assert load() == [(1, "v2"), (2, "t2"), (3, "t3")]


ITEM_DAY = {"published_at": "2024-01-02T00:00:00Z"}


def test_an_old_day_run_again_does_not_win(spark, layout, tmp_path):
    land(tmp_path / "one", "articles", page(item(1, title="old", updated_at="2024-01-02T00:00:00Z", **ITEM_DAY), last=True))
    land(tmp_path / "two", "articles", page(item(1, title=" new ", updated_at="2024-01-03T00:00:00Z", **ITEM_DAY), last=True))
    for day, folder in (("2024-04-01", "one"), ("2024-04-02", "two")):
        run(spark, Layout(layout.bronze, layout.silver, layout.gold, str(tmp_path / folder)), "ingest,silver", ingestion_date=day)
    run(spark, layout, "silver", ingestion_date="2024-04-01")
    assert rows(stored(spark, layout, "articles"), "id", "title") == [(1, "new")]
    run(spark, layout, "silver", ingestion_date="2024-04-01", replace_newer=True)
    assert rows(stored(spark, layout, "articles"), "id", "title") == [(1, "old")]


def test_rows_of_no_known_type_are_counted_and_no_info_folder_is_no_info(spark, layout, tmp_path):
    land(tmp_path / "landing", "videos", page(item(1, updated_at="2024-01-02T00:00:00Z", **ITEM_DAY), last=True))
    done = run(spark, Layout(layout.bronze, layout.silver, layout.gold, layout.landing), "ingest,silver", ingestion_date="2024-04-01")
    assert done["ingest"]["written"] == 1 and done["silver"]["unrouted"] == 1 and done["silver"]["unreadable_lists"] == 0
    run(spark, layout, "silver", ingestion_date="2024-04-01")
    assert spark.read.parquet(layout.quarantine).count() == 1
    assert bronze.read_bronze(spark, layout.bronze, "2024-04-01").count() == 1


def test_a_second_day_reads_and_counts_only_what_is_new(spark, layout, tmp_path):
    landing, info = tmp_path / "landing", {"version": "4.9.0", "news_sites": ["A"]}
    first = [item(1, news_site="A", updated_at="2024-01-02T00:00:00Z", **ITEM_DAY), item(2, news_site="B", updated_at="2024-01-02T00:00:00Z", **ITEM_DAY)]
    for day, items, sites in (("2024-04-01", first, ["A"]), ("2024-04-02", [item(3, news_site="A", published_at="2024-02-05T00:00:00Z", updated_at="2024-02-05T00:00:00Z")], ["A", "B"])):
        for endpoint, content in (("articles", page(*items, last=True)), ("info", info | {"news_sites": sites})):
            folder = landing / f"endpoint={endpoint}" / f"landed={day}"
            folder.mkdir(parents=True)
            (folder / "1.json").write_text(content if isinstance(content, str) else json.dumps(content))
    where = Layout(layout.bronze, layout.silver, layout.gold, str(landing))
    done = run(spark, where, "ingest,silver,dims,facts,aggregates", ingestion_date="2024-04-01")
    assert done["ingest"]["fetched"] == 3
    done = run(spark, where, "ingest,silver,dims,facts,aggregates", ingestion_date="2024-04-02", incremental=True)
    assert done["ingest"]["fetched"] == 2
    # The item whose site was listed on the second day has its id now.
    assert rows(stored(spark, where, "fact_article"), "article_id", "news_source_id") == [(1, 1), (2, 2), (3, 1)]
    assert set(done["facts"].partitions) == {("2024", "01", "02"), ("2024", "02", "05")}
    assert rows(stored(spark, where, "agg_month"), "year", "month", "article_count") == [("2024", "01", 2), ("2024", "02", 1)]
    assert rows(stored(spark, where, "agg_source_day"), "news_site", "day", "article_count") == [("A", "02", 1), ("A", "05", 1), ("B", "02", 1)]
    before = sorted(files.matching(spark, f"{where.table('agg_month')}/year=2024/month=01/*"))
    land(tmp_path / "third", "articles", page(item(4, published_at="2024-02-06T00:00:00Z", updated_at="2024-02-06T00:00:00Z"), last=True))
    third = Layout(layout.bronze, layout.silver, layout.gold, str(tmp_path / "third"))
    run(spark, third, "ingest,silver,facts,aggregates", ingestion_date="2024-04-03")
    assert rows(stored(spark, where, "agg_month"), "year", "month", "article_count") == [("2024", "01", 2), ("2024", "02", 2)]
    assert sorted(files.matching(spark, f"{where.table('agg_month')}/year=2024/month=01/*")) == before


def test_phases_leave_no_staged_copies(spark, layout, tmp_path):
    before = files.matching(spark, f"{scratch_root(spark)}/*")
    _land_first_day(tmp_path)
    run(spark, layout, "ingest,silver,dims,facts,aggregates", ingestion_date="2024-04-01")
    assert files.matching(spark, f"{scratch_root(spark)}/*") == before


def test_catalog_arguments():
    assert flow.parse_catalogs(["lake.impl=some.Class", "lake.warehouse=/w"]) == {"lake": {"impl": "some.Class", "warehouse": "/w"}}
    with pytest.raises(ValueError, match="NAME.KEY=VALUE"):
        flow.parse_catalogs(["lake"])


def test_what_did_not_arrive_is_told_and_kept(spark, layout, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "articles", page(item(1), item(2), count=6), page(item(5), item(6), offset=4, count=6, last=True))
    with open(folder / "endpoint=articles" / "pages.json", "a") as f:
        f.write("\n" + json.dumps(page(item(3), item(4), offset=2, count=6))[:-20])
    for _ in range(2):
        done = run(spark, layout, "ingest,silver", ingestion_date="2024-04-01")
        assert done["arrival"] == {"broken_pages": 1, "partly_read": 0, "missing": 2, "repeated": 0, "beyond": 0}
    assert bronze.read_bronze(spark, layout.bronze, "2024-04-01").count() == 4
    assert rows(spark.read.parquet(f"{layout.quarantine}_pages/ingestion_date=2024-04-01"), "endpoint", "reason") == [("articles", "unreadable")]
    assert rows(spark.read.parquet(f"{layout.quarantine}_gaps/ingestion_date=2024-04-01")) == [("articles", "missing", 2, 4)]
    run(spark, layout, "ingest", ingestion_date="2024-04-01", load="second")
    assert bronze.read_bronze(spark, layout.bronze, "2024-04-01").count() == 8


def test_aggregates_follow_by_changes_when_items_move_month(spark, layout, tmp_path, monkeypatch):
    def day(name, date, *items_):
        land(tmp_path / name, "articles", page(*items_, last=True, count=len(items_)))
        land(tmp_path / name, "info", {"version": "4.9.0", "news_sites": ["A", "B"]})
        where = Layout(layout.bronze, layout.silver, layout.gold, str(tmp_path / name))
        return run(spark, where, "ingest,silver,dims,facts,aggregates", ingestion_date=date)

    def recounted():
        names = ("agg_month", "agg_topic_day", "agg_topic_month", "agg_source_day", "agg_source_month")
        kept = {n: rows(stored(spark, layout, n)) for n in names}
        flow.aggregates_phase(spark, layout)
        assert kept == {n: rows(stored(spark, layout, n)) for n in names}
        assert not list((tmp_path / "gold").glob("_behind_*"))
        return kept

    def made(i, month, updated, site="A"):
        return item(i, news_site=site, published_at=f"2024-{month}-02T00:00:00Z", updated_at=f"2024-{month}-{updated}T00:00:00Z")

    day("d1", "2024-04-01", made(1, "01", "02"), made(2, "01", "02", "B"), made(3, "02", "02", "Nowhere"))
    recounted()
    done = day("d2", "2024-04-02", made(3, "03", "03"), made(1, "01", "03", "B"), made(4, "03", "02"))
    assert done["facts"].changes is not None
    assert recounted()["agg_month"] == [(2, "2024", "01"), (2, "2024", "03")]  # nothing is left of February

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(flow, "replace_table", lost)
        with pytest.raises(RuntimeError):
            day("d3", "2024-04-03", made(4, "05", "04"))
    day("d4", "2024-04-04", made(5, "06", "02"))
    assert (1, "2024", "05") in recounted()["agg_month"]

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from galley.schemas import BRONZE_CONTENT, ITEM
from galley.sources import bronze, landed


def page(*items, count=10, offset=0, limit=2, last=False):
    base = "https://example.org/v1/articles/?limit=%d&offset=%d"
    return {
        "count": count,
        "next": None if last else base % (limit, offset + limit),
        "previous": base % (limit, offset - limit) if offset else None,
        "results": list(items),
    }


def item(id, **more):
    return {"id": id, "title": f"t{id}", "news_site": "S", "published_at": "2024-01-02T03:04:05Z", "updated_at": "2024-01-02T03:04:05.5Z", **more}


def land(folder, endpoint, *pages):
    target = folder / f"endpoint={endpoint}"
    target.mkdir(parents=True, exist_ok=True)
    (target / "pages.json").write_text("\n".join(json.dumps(p) for p in pages))


def test_page_gives_items_and_declared_total(spark, tmp_path):
    land(tmp_path, "articles", page(item(1)))
    items = landed.read_pages(spark, f"{tmp_path}/endpoint=articles", "article")
    assert rows(items, "id", "declared_total", "content_type") == [(1, 10, "article")]


def test_type_follows_from_the_endpoint_folder(spark, tmp_path):
    for endpoint in ("articles", "blogs", "reports"):
        land(tmp_path, endpoint, page(item(1)))
    land(tmp_path, "info", {"version": "4.1.0", "news_sites": ["A"]})
    assert rows(landed.read_pages(spark, str(tmp_path)), "content_type", "id") == [("article", 1), ("blog", 1), ("report", 1)]


def test_whole_page_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(page(item(1), item(2)), indent=2))
    assert landed.read_pages(spark, str(tmp_path), "article", multi_line=True).count() == 2


def test_arrival_follows_the_listing_not_the_files(spark, tmp_path):
    land(tmp_path, "articles", page(item(5), offset=4, last=True), page(item(3), item(4), offset=2), page(item(1), item(2)))
    got = landed.read_pages(spark, str(tmp_path)).orderBy("arrival").collect()
    assert [(r["id"], r["arrival"]) for r in got] == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_field_only_a_later_record_has_survives(spark, tmp_path):
    land(tmp_path, "articles", page(item(1), item(2, featured=True, authors=[{"name": "N", "socials": {"x": "@n"}}])))
    items = landed.read_pages(spark, str(tmp_path))
    assert rows(items, "id", "featured", F.col("authors")[0]["socials"]["x"]) == [(1, None, None), (2, True, "@n")]


def test_info_record_and_combination(spark, tmp_path):
    land(tmp_path, "info", {"version": "4.1.0", "news_sites": ["A", "B"]})
    info = landed.read_info(spark, f"{tmp_path}/endpoint=info")
    assert rows(info) == [(0, "info", "4.1.0", ["A", "B"])]
    items = spark.createDataFrame([(1, "article", "t")], "id long, content_type string, title string")
    assert rows(landed.combine([items, items], info), "id", "title", "version") == [(0, None, "4.1.0"), (1, "t", None), (1, "t", None)]


def _content(spark, *data):
    shape = T.StructType([*T.StructType.fromDDL("id long, content_type string, title string").fields, ITEM["authors"]])
    return spark.createDataFrame([(i, kind, f"t{i}", []) for i, kind in data], shape)


def test_write_makes_every_partition_folder(spark, tmp_path):
    written = bronze.write_bronze(_content(spark, (1, "article"), (2, "blog")), None, str(tmp_path), "2024-02-05")
    assert written == 2
    for kind in ("article", "blog"):
        assert list((tmp_path / f"content_type={kind}/year=2024/month=02/day=05").glob("*.parquet"))


def test_nothing_to_write(spark, tmp_path):
    assert bronze.write_bronze(_content(spark), None, str(tmp_path), "2024-02-05") == 0
    assert not list(tmp_path.rglob("*.parquet"))


def test_second_write_adds_files(spark, tmp_path):
    for _ in range(2):
        bronze.write_bronze(_content(spark, (1, "article")), None, str(tmp_path), "2024-02-05")
    assert bronze.read_bronze(spark, str(tmp_path), "2024-02-05").count() == 2


def test_date_and_type_are_partition_filters(spark, tmp_path, plan):
    path = str(tmp_path)
    bronze.write_bronze(_content(spark, (1, "article"), (2, "blog")), None, path, "2024-02-05")
    bronze.write_bronze(_content(spark, (3, "article")), None, path, "2024-02-06")
    day = bronze.read_bronze(spark, path, "2024-02-05", "article", schema=BRONZE_CONTENT)
    assert rows(day, "id", "year", "month", "day") == [(1, "2024", "02", "05")]
    filters = plan(day).split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert all(name in filters for name in ("content_type", "year", "month", "day"))


def test_date_never_loaded_gives_no_rows(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    assert bronze.read_bronze(spark, path, "2024-02-05").count() == 0
    bronze.write_bronze(_content(spark, (1, "article")), None, path, "2024-02-05")
    assert bronze.read_bronze(spark, path, "2024-02-06").count() == 0


def test_info_has_its_own_schema(spark, tmp_path):
    path = str(tmp_path)
    info = spark.createDataFrame([(None, None, None, None)], "id long, content_type string, version string, news_sites array<string>")
    bronze.write_bronze(_content(spark, (1, "article")), info, path, "2024-02-05")
    assert rows(bronze.read_bronze(spark, path, "2024-02-05", "info"), "id", "content_type", "version", "news_sites") == [(0, "info", "", [])]


def test_routing_by_type(spark):
    df = spark.createDataFrame([(1, "INFO"), (2, "info"), (3, "blog"), (4, None)], "id long, content_type string")
    content, info = bronze.split_info(df)
    assert rows(content, "id") == [(3,), (4,)] and rows(info, "id") == [(1,), (2,)]


def test_nested_columns_as_json(spark):
    df = spark.createDataFrame([(1, [("a",)], None)], "id long, authors array<struct<name:string>>, events array<int>")
    assert rows(bronze.nested_as_json(df)) == [(1, '[{"name":"a"}]', None)]


def test_inspect_keeps_what_exists(spark):
    df = spark.createDataFrame([(i, "x", i) for i in range(60)], "id long, version string, other int")
    schema, count, head = bronze.inspect(df)
    assert rows(schema) == [("id", "bigint"), ("version", "string")]
    assert count.first()[0] == 60 and head.count() == 50


def test_bad_run_date(spark, tmp_path):
    with pytest.raises(ValueError):
        bronze.write_bronze(_content(spark, (1, "article")), None, str(tmp_path), "05/02/2024")


def test_item_schema_is_declared():
    assert [f.name for f in ITEM.fields][:3] == ["id", "title", "url"]


def test_broken_pages_are_told_and_whole_ones_kept(spark, tmp_path):
    whole, cut = json.dumps(page(item(1), item(2))), json.dumps(page(item(3), item(4), offset=2))[:-30]
    mistyped = json.dumps(page({**item(5), "featured": "perhaps"}, item(6), offset=4))
    error = json.dumps({"detail": "too many requests"})
    target = tmp_path / "endpoint=articles"
    target.mkdir()
    (target / "pages.json").write_text("\n".join([whole, cut, mistyped, error]))
    land(tmp_path, "info", {"version": "4.1.0", "news_sites": ["A"]})
    envelopes = landed.read_envelopes(spark, str(tmp_path))
    assert rows(landed.items_of(envelopes), "id", "featured") == [(1, None), (2, None), (5, None), (6, None)]
    told = {r["reason"]: r["page"] for r in landed.broken_pages(envelopes).collect()}
    assert set(told) == {"unreadable", "partly read", "no results"} and told["unreadable"] == cut


def test_a_whole_file_that_is_cut_off_is_told(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(page(item(1)), indent=1))
    (tmp_path / "b.json").write_text(json.dumps(page(item(2)), indent=1)[:-8])
    envelopes = landed.read_envelopes(spark, str(tmp_path), multi_line=True)
    assert rows(landed.broken_pages(envelopes), "reason") == [("unreadable",)]
    assert landed.read_pages(spark, str(tmp_path), "article", multi_line=True).count() == 1


def test_chain_gaps_of_a_listing_that_moved(spark, tmp_path):
    pages = [page(item(1), item(2)), page(item(2), item(3), offset=1), page(item(9), offset=8), page(item(11), offset=10, last=True)]
    land(tmp_path, "articles", *pages)
    land(tmp_path, "blogs", page(item(1), item(2), count=2, last=True))
    gaps = landed.chain_gaps(landed.read_envelopes(spark, str(tmp_path)))
    assert rows(gaps) == [
        ("articles", "beyond", 10, 11), ("articles", "missing", 3, 8), ("articles", "missing", 9, 10), ("articles", "repeated", 1, 2),
    ]


def test_a_named_load_run_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "bronze")
    items = spark.createDataFrame([(i, ("article", "blog", None)[i % 3]) for i in range(9)], "id long, content_type string")
    record = spark.createDataFrame([("4.1.0", ["A"])], "version string, news_sites array<string>")
    for _ in range(2):
        bronze.write_bronze(items, None, path, "2024-05-01", load="morning")
        bronze.write_bronze(None, landed.info_item(record), path, "2024-05-01", load="morning")
    bronze.write_bronze(items.filter("id < 2"), None, path, "2024-05-01", load="evening")
    bronze.write_bronze(items, None, path, "2024-05-02", load="morning")
    assert bronze.read_bronze(spark, path, "2024-05-01").count() == 9 + 1 + 2
    bronze.write_bronze(items.filter("id = 0"), None, path, "2024-05-01", load="morning")
    kept = bronze.read_bronze(spark, path, "2024-05-01")
    assert rows(kept, "content_type", "id") == [("article", 0), ("article", 0), ("blog", 1), ("info", 0)]
    bronze.write_bronze(items.limit(0), None, path, "2024-05-01", load="evening")
    assert bronze.read_bronze(spark, path, "2024-05-01").count() == 2 and bronze.read_bronze(spark, path).count() == 2 + 9
    with pytest.raises(ValueError):
        bronze.write_bronze(items, None, path, "2024-05-01", load="a/b")


def test_days_stored_without_loads_are_still_read(spark, tmp_path):
    path = str(tmp_path / "bronze")
    old = spark.createDataFrame([(1, "article")], "id long, content_type string")
    shaped = bronze.conform(bronze.with_date_parts(old, ("2024", "05", "01")), BRONZE_CONTENT)
    bronze.append_partitioned(shaped, path)
    bronze.write_bronze(old, None, path, "2024-05-01")
    bronze.write_bronze(old, None, path, "2024-05-02", load="x")
    assert bronze.read_bronze(spark, path, "2024-05-01").count() == 2
    assert bronze.read_bronze(spark, path, content_type="article").count() == 3


def test_inspect_in_order(spark):
    df = spark.range(200).repartition(7)
    assert [r["id"] for r in bronze.inspect(df, n=3, order_by=("id",))[2].collect()] == [0, 1, 2]

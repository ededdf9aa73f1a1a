import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F, types as T

from galley.functions.dates import parse_run_date, with_date_parts, with_text_date_parts
from galley.functions.text import parse_list, parse_records, version_key, words
from galley.operators import incremental, quality
from galley.operators.conform import conform, union_content
from galley.operators.joins import join_dimension
from galley.plans import silver


def test_list_text(spark):
    cases = {
        "['Orbit Daily', 'Virgin Galactic']": ["Orbit Daily", "Virgin Galactic"],
        "['Only']": ["Only"],
        "[\"O'Hara\", 'B']": ["O'Hara", "B"],
        "['say \\'hi\\' \"now\"']": ["say 'hi' \"now\""],
        "[]": [],
        "": None,
        None: None,
        "garbage": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", parse_list("t")).collect()} == cases


def test_only_named_sites_get_rows(spark):
    data = [("['A', 'Virgin Galactic']",), ("[]",), ("",), (None,), ("junk",)]
    df = spark.createDataFrame(data, "news_sites string")
    assert rows(silver.explode_sites(df), "news_site") == [("A",), ("Virgin Galactic",)]


def test_native_list_needs_no_parsing(spark):
    df = spark.createDataFrame([(["A", None],), ([],), (None,)], "news_sites array<string>")
    assert rows(silver.explode_sites(df), "news_site") == [("A",), (None,)]


def test_record_text(spark):
    text = "[{'name': \"O'Neil: None, really\", 'socials': None, 'staff': True}, {'name': 'B', 'socials': {'x': '@b', 'youtube': None}}]"
    df = spark.createDataFrame([(text,)], "t string")
    ddl = "array<struct<name:string, socials:struct<x:string, youtube:string>, staff:boolean>>"
    first, second = df.select(parse_records("t", ddl).alias("a")).first()["a"]
    assert (first["name"], first["socials"], first["staff"]) == ("O'Neil: None, really", None, True)
    assert second["socials"].asDict() == {"x": "@b", "youtube": None}


def test_authors(spark):
    schema = "id long, authors array<struct<name:string, socials:struct<x:string,youtube:string,instagram:string,linkedin:string,mastodon:string,bluesky:string>>>"
    df = spark.createDataFrame([(1, [("A", ("@a",) + (None,) * 5), ("B", None)]), (2, []), (3, None)], schema)
    got = rows(silver.explode_authors(df), "id", "author_name", "x")
    assert got == sorted([(1, "A", "@a"), (1, "B", None), (2, None, None), (3, None, None)], key=repr)


def test_versions_sort_by_number(spark):
    df = spark.createDataFrame([("4.9.0",), ("4.29.0",), ("v4.10",), (None,)], "v string")
    ordered = [r[0] for r in df.orderBy(version_key("v")).collect()]
    assert ordered == [None, "4.9.0", "v4.10", "4.29.0"]


def test_words(spark):
    df = spark.createDataFrame([("The NASA-ESA crew, été 4you; ab",)], "t string")
    assert df.select(words("t")).first()[0] == ["the", "nasa", "esa", "crew", "été", "you", "ab"]
    assert df.select(words("t", 4)).first()[0] == ["nasa", "crew"]


def test_date_parts_from_column_constant_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 5, 23, 59), "2023-11-09T00:00:00Z")], "ts timestamp, iso string")
    assert rows(with_date_parts(df, "ts"), "year", "month", "day") == [("2024", "02", "05")]
    assert rows(with_date_parts(df, dt.date(987, 1, 2)), "year", "month", "day") == [("0987", "01", "02")]
    assert rows(with_text_date_parts(df, "iso"), "year", "month", "day") == [("2023", "11", "09")]


def test_run_date():
    assert parse_run_date("2024-02-05") == ("2024", "02", "05")
    assert parse_run_date(None) is None
    for bad in ("2024-13-01", "yesterday", ""):
        with pytest.raises(ValueError):
            parse_run_date(bad)


def test_conform(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = conform(spark.createDataFrame([(1, 2)], "x int, a int"), schema)
    assert df.schema == schema and rows(df) == [(2, None)]


def test_union_fills_what_a_table_lacks(spark):
    parts = {
        "article": spark.createDataFrame([(1, "S", "2024", "01", "02")], "id long, news_site string, year string, month string, day string"),
        "blog": spark.createDataFrame([(2, "2024", "01", "03", True)], "id long, year string, month string, day string, featured boolean"),
    }
    assert rows(union_content(parts), "id", "content_type", "news_site", "featured") == [(1, "article", "S", None), (2, "blog", None, True)]
    assert rows(union_content(parts, "2024-01-03"), "id") == [(2,)]
    without = {"article": parts["article"].drop("news_site")}
    assert rows(union_content(without), "id", "news_site") == [(1, None)]


def test_day_filter_reaches_the_files_of_each_branch(spark, tmp_path, plan):
    df = spark.createDataFrame([(1, "2024", "01", "02"), (2, "2024", "01", "03")], "id long, year string, month string, day string")
    df.write.partitionBy("year", "month", "day").parquet(f"{tmp_path}/t")
    part = spark.read.schema(df.schema).parquet(f"{tmp_path}/t")
    text = plan(union_content({"article": part, "blog": part}, "2024-01-02"))
    assert text.count("(day#") >= 2 and "PartitionFilters: []" not in text


@pytest.fixture
def rules(spark):
    return quality.content_rules(("article", "blog"), "2000-01-01", "2030-01-01")


def _checked(spark):
    data = [
        (1, "article", "ok", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)),
        (None, "blog", " ", dt.datetime(1999, 1, 1), dt.datetime(2024, 1, 2)),
        (3, "video", None, None, dt.datetime(2024, 1, 2)),
        (4, None, "t", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 2)),
    ]
    return spark.createDataFrame(data, "id long, content_type string, title string, published_at timestamp, updated_at timestamp")


def test_validation_counts(spark, rules):
    assert {r["rule"]: r["violations"] for r in quality.validate(_checked(spark), rules).collect()} == {
        "id_missing": 1, "type_unknown": 2, "title_blank": 2, "published_missing": 1, "published_out_of_range": 1, "updated_before_published": 1,
    }


def test_quarantine_splits_without_loss(spark, rules):
    good, bad = quality.quarantine(_checked(spark), rules)
    assert rows(good, "id") == [(1,)]
    assert {r["id"]: r["failed_rules"] for r in bad.collect()} == {
        None: ["id_missing", "title_blank", "published_out_of_range"],
        3: ["type_unknown", "title_blank", "published_missing"],
        4: ["type_unknown", "updated_before_published"],
    }


def test_schema_differences(spark):
    expected = T.StructType.fromDDL("id bigint, title string")
    df = spark.createDataFrame([(1, 2)], "id int, extra int")
    assert rows(quality.schema_differences(df, expected)) == [("extra", None, "int"), ("id", "bigint", "int"), ("title", "string", None)]
    assert quality.schema_differences(df.select(F.col("id").cast("long").alias("id"), F.lit("x").alias("title")), expected).count() == 0


def test_unknown_sources(spark):
    items = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id long, news_site string")
    official = spark.createDataFrame([("A",), ("A",), (None,)], "news_site string")
    assert rows(quality.unknown_sources(items, official), "id") == [(2,)]


def test_counts_and_minimum(spark):
    counts = quality.layer_counts({("silver", "a"): spark.range(3), ("gold", "f"): spark.range(0)})
    assert rows(counts) == [("gold", "f", 0), ("silver", "a", 3)]
    assert rows(quality.below_minimum(counts, {("silver", "a"): 3, ("gold", "f"): 1}), "entity") == [("f",)]


def test_marks(spark):
    schema = "content_type string, id long, published_at timestamp, updated_at timestamp"

    def at(day):
        return dt.datetime(2024, 1, day)

    stored = spark.createDataFrame([("article", 1, at(1), at(5)), ("article", 2, at(3), at(4))], schema)
    marks = incremental.high_water_marks(stored)
    assert rows(marks) == [("article", at(3), at(5))]
    incoming = spark.createDataFrame([("article", 1, at(1), at(5)), ("article", 3, at(6), at(6)), ("blog", 9, at(1), at(1))], schema)
    # As old as the mark: taken again, as it may be another item of that moment.
    assert rows(incremental.after_marks(incoming, marks), "id") == [(1,), (3,), (9,)]
    gaps = spark.createDataFrame(
        [("article", 4, at(2), None), ("article", 5, at(3), None), ("article", 6, None, None), ("article", 7, at(9), at(4)), (None, 8, at(1), at(1))], schema
    )
    assert rows(incremental.after_marks(gaps, marks), "id") == [(5,), (6,), (8,)]
    nothing_stored = incremental.high_water_marks(stored.limit(0))
    assert incremental.after_marks(incoming, nothing_stored).count() == 3


def test_date_bounds_are_pushed_down(spark, sf, plan):
    df = spark.read.parquet(f"{sf}/orders.parquet").withColumnsRenamed({"o_orderdate": "published_at"})
    bounded = incremental.within_dates(df, F.lit("1996-01-01").cast("timestamp_ntz"))
    assert "GreaterThanOrEqual(o_orderdate" in plan(bounded)
    assert incremental.within_dates(df) is df


def test_dimension_join_measures_before_it_broadcasts(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1b")
    try:
        facts, dim = spark.range(1000).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
        small, large = join_dimension(facts, dim, "k"), join_dimension(facts, dim, "k", limit=100)
        assert "BroadcastHashJoin" in plan(small)
        assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
        assert small.count() == large.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from galley.operators.ranking import cap_per_group, number_rows, parse_cap


@pytest.mark.parametrize(
    "given, cap",
    [(None, None), ("", None), ("all", None), (" TODO ", None), ("full", None), ("x", None), ("-3", None), (7, 7), ("12", 12), (0, 0)],
)
def test_cap_argument(given, cap):
    assert parse_cap(given) == cap


def test_numbers_are_dense_and_ordered(spark):
    names = [f"n{i:05d}" for i in random.Random(3).sample(range(100_000), 5000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = {r["name"]: r["row_no"] for r in number_rows(df, ["name"]).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names), 1)}


def test_numbers_restart_per_group_even_when_one_group_is_most_of_the_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 10 < 9, "big").otherwise(F.concat(F.lit("g"), F.col("id"))).alias("g"), (-F.col("id")).alias("v"))
    got = number_rows(df, ["v"], ["g"]).toPandas()
    want = got.groupby("g")["v"].rank().astype(int)
    assert (got["row_no"] == want).all()


def test_hot_group_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).select(F.lit("only").alias("g"), "id")
        staged = [f for f in number_rows(df, ["id"], ["g"]).inputFiles() if "/numbered-" in f]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [spark.read.parquet(f).count() for f in staged]
    assert sum(sizes) == 8000 and len(sizes) > 1 and max(sizes) < 8000 / 2


def test_null_group_is_numbered_too(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    assert rows(number_rows(df, ["v"], ["g"]), "v", "row_no") == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 1001, 2500])
def test_cap_keeps_exactly_the_first(spark, n):
    df = spark.range(6000).select((F.col("id") % 2).alias("content_type"), "id")
    kept = cap_per_group(df, ["content_type"], ["id"], n)
    assert kept.count() == 2 * n
    assert kept.agg(F.max("id")).first()[0] == (2 * n - 1 if n else None)


def test_no_cap(spark):
    df = spark.range(10)
    assert cap_per_group(df, ["id"], ["id"], "all") is df


def test_small_cap_is_applied_before_the_shuffle(spark, plan):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    text = plan(cap_per_group(df, ["g"], ["id"], 10))
    assert "WindowGroupLimit" in text and "Partial" in text

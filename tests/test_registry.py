import duckdb
import pytest

import __spark_entry__ as entry_point
from check import TABLES, canonical
from galley.registry.base import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    got = canonical(QUERIES[name](spark, sf).toPandas())
    want = canonical(duck.sql(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point_has_every_query():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_flagship(spark):
    assert entry_point.entry(spark).columns == ["news_site", "total_publications"]

import pytest
from helpers import rows
from pyspark.sql import Window, functions as F

from galley.sources import files, tables
from galley.sources.tables import ensure_table, finish_pending, read_table, replace_table, table_exists, upsert

KEYS = ("content_type", "id")
PARTS = ("year", "month")
SCHEMA = "content_type string, id long, title string, updated_at string, year string, month string"


def items(spark, *data):
    return spark.createDataFrame([("article", *d) for d in data], SCHEMA)


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/articles"


def load(spark, path, *batches, **options):
    return [upsert(items(spark, *b), path, KEYS, PARTS, **options) for b in batches]


def stored(spark, path):
    return rows(read_table(spark, path, items(spark).schema), "id", "title", "year", "month")


FIRST = [(1, "old", "1", "2024", "01"), (2, "b", "1", "2024", "02")]
SECOND = [(1, "new", "2", "2024", "01"), (3, "c", "1", "2025", "01")]


def test_upsert(spark, path):
    done = load(spark, path, FIRST, SECOND)
    assert stored(spark, path) == [(1, "new", "2024", "01"), (2, "b", "2024", "02"), (3, "c", "2025", "01")]
    assert [d.created for d in done] == [True, False]
    assert done[1].touched_partitions == 2


def test_upsert_twice_changes_nothing(spark, path):
    load(spark, path, FIRST, SECOND)
    before = stored(spark, path)
    load(spark, path, SECOND)
    assert stored(spark, path) == before


def test_untouched_partition_files_stay(spark, path):
    load(spark, path, FIRST)
    untouched = read_table(spark, path, items(spark).schema).filter("month = '02'").inputFiles()
    kept = [f for f in untouched if "month=02" in f]
    load(spark, path, SECOND)
    assert kept and all(files.exists(spark, f) for f in kept)


def test_row_that_moves_leaves_no_copy(spark, path):
    load(spark, path, [(1, "a", "1", "2024", "01")], [(1, "a", "2", "2025", "03")])
    assert stored(spark, path) == [(1, "a", "2025", "03")]
    assert not files.exists(spark, f"{path}/year=2024/month=01")


def test_null_and_odd_partition_values(spark, path):
    load(spark, path, [(1, "a", "1", None, "01"), (2, "b", "1", "a/b=c", "x y")])
    load(spark, path, [(1, "a2", "2", None, "01"), (2, "b2", "2", "2024", "01")])
    assert stored(spark, path) == [(1, "a2", None, "01"), (2, "b2", "2024", "01")]
    assert sum("a%2Fb" in f for f in read_table(spark, path, items(spark).schema).inputFiles()) == 0


def test_repeated_key_is_an_error(spark, path):
    with pytest.raises(ValueError, match="several rows for one key"):
        load(spark, path, [(1, "a", "1", "2024", "01"), (1, "b", "1", "2024", "01")])
    assert not table_exists(spark, path)


def test_null_key_is_dropped_and_counted(spark, path):
    batch = [(None, "x", "1", "2024", "01"), (None, "y", "1", "2024", "01"), (1, "a", "1", "2024", "01")]
    done = load(spark, path, batch, batch)
    assert [d.null_key_rows for d in done] == [2, 2]
    assert stored(spark, path) == [(1, "a", "2024", "01")]


def test_first_load_of_a_trusted_batch_counts_too(spark, path):
    done = load(spark, path, [(None, "x", "1", "2024", "01"), (1, "a", "1", "2024", "01")], check_unique=False)[0]
    assert (done.created, done.batch_rows, done.null_key_rows) == (True, 2, 1)
    assert stored(spark, path) == [(1, "a", "2024", "01")]


def test_newer_by_keeps_the_newer_row(spark, path):
    load(spark, path, [(1, "new", "5", "2024", "01"), (2, "b", None, "2024", "01")])
    load(spark, path, [(1, "old", "3", "2023", "12"), (2, "b2", "1", "2024", "01"), (3, "c", "1", "2024", "01")], newer_by="updated_at")
    assert stored(spark, path) == [(1, "new", "2024", "01"), (2, "b2", "2024", "01"), (3, "c", "2024", "01")]
    assert load(spark, path, [(1, "older", "2", "2020", "01")], newer_by="updated_at")[0].touched_partitions == 0


def test_default_lets_a_replay_overwrite(spark, path):
    load(spark, path, [(1, "new", "5", "2024", "01")], [(1, "old", "3", "2024", "01")])
    assert stored(spark, path) == [(1, "old", "2024", "01")]


def test_empty_batch(spark, path):
    load(spark, path, FIRST)
    assert load(spark, path, [])[0].touched_partitions == 0
    assert len(stored(spark, path)) == 2


def test_unchanged_rows_are_not_rewritten(spark, path):
    load(spark, path, FIRST + SECOND[1:])
    before = set(read_table(spark, path, items(spark).schema).inputFiles())
    assert load(spark, path, FIRST + SECOND[1:], skip_unchanged=True)[0].touched_partitions == 0
    changed = [(1, None, "1", "2024", "01"), *FIRST[1:], *SECOND[1:], (4, "d", None, "2025", "01")]
    assert load(spark, path, changed, skip_unchanged=True)[0].touched_partitions == 2
    assert stored(spark, path) == sorted([(i, t, y, m) for i, t, _, y, m in changed], key=repr)
    after = set(read_table(spark, path, items(spark).schema).inputFiles())
    assert {f for f in before if "month=02" in f} <= after
    moved = [(2, "b", "1", "2026", "02")]
    assert load(spark, path, changed[:1] + moved, skip_unchanged=True)[0].touched_partitions == 2
    assert [r for r in stored(spark, path) if r[0] == 2] == [(2, "b", "2026", "02")]


def test_unpartitioned_table(spark, path):
    schema = "topic_id string, topic_name string"
    for batch in ([("a", "A"), ("b", "B")], [("b", "B2"), ("c", "C")]):
        upsert(spark.createDataFrame(batch, schema), path, ["topic_id"])
    assert rows(read_table(spark, path)) == [("a", "A"), ("b", "B2"), ("c", "C")]


def test_partition_columns_inside_the_key_limit_the_lookup(spark, path):
    schema = "news_site string, year string, month string, version string"
    for batch in ([("s", "2024", "01", "1"), ("s", "2024", "02", "1")], [("s", "2024", "02", "2")]):
        done = upsert(spark.createDataFrame(batch, schema), path, ["news_site", "year", "month"], PARTS)
    assert done.touched_partitions == 1
    assert rows(read_table(spark, path), "year", "month", "version") == [("2024", "01", "1"), ("2024", "02", "2")]


def test_interrupted_publication_is_finished(spark, path, monkeypatch):
    load(spark, path, FIRST)
    real, moved = files.replace, []

    def dies_on_the_second(spark_, source, target, folders):
        moved.extend(folders[:1])
        real(spark_, source, target, folders[:1])
        raise OSError("driver lost")

    monkeypatch.setattr(files, "replace", dies_on_the_second)
    with pytest.raises(OSError):
        load(spark, path, SECOND)
    monkeypatch.setattr(files, "replace", real)
    assert len(moved) == 1
    assert finish_pending(spark, path) and not finish_pending(spark, path)
    assert stored(spark, path) == [(1, "new", "2024", "01"), (2, "b", "2024", "02"), (3, "c", "2025", "01")]


def test_create_if_absent(spark, path):
    schema = items(spark).schema
    assert ensure_table(spark, path, schema, PARTS)
    assert not ensure_table(spark, path, schema, PARTS)
    assert read_table(spark, path, schema).count() == 0
    load(spark, path, FIRST)
    assert len(stored(spark, path)) == 2


def test_replace_drops_stale_partitions(spark, path):
    replace_table(items(spark, *FIRST), path, PARTS)
    replace_table(items(spark, *SECOND), path, PARTS)
    assert stored(spark, path) == [(1, "new", "2024", "01"), (3, "c", "2025", "01")]


def test_scratch_is_removed(spark, path):
    from galley.session import scratch_root

    load(spark, path, FIRST, SECOND)
    fs, root = files._path(spark, scratch_root(spark))
    left = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    assert not [n for n in left if n.startswith("upsert")]


def test_catalog_table_uses_merge(spark, monkeypatch):
    """A row-level catalog is not at hand here; check the statement that would be sent to it."""
    sent = []

    class Writer:
        def __getattr__(self, name):
            def step(*args):
                sent.append(name)
                return self

            return step

    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "mergeInto", lambda self, table, on: sent.append((table, str(on))) or Writer())
    tables._merge(items(spark, *FIRST), "lake.silver.articles", KEYS, "updated_at")
    table, on = sent[0]
    assert table == "lake.silver.articles" and "lake.silver.articles.id" in on and "batch.content_type" in on
    assert sent[1:] == ["whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]


def test_catalog_identifier_without_row_level_support(spark):
    """The session catalog can create and read; Spark itself refuses MERGE on plain Parquet."""
    name = "default.galley_topics"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        df = spark.createDataFrame([("a", "A")], "topic_id string, topic_name string")
        assert upsert(df, name, ["topic_id"]).created
        assert rows(read_table(spark, name)) == [("a", "A")]
        with pytest.raises(Exception, match="MERGE"):
            upsert(df, name, ["topic_id"])
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stored_three(spark, path):
    upsert(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, part string, extra string"), path, ["id"], ["part"])


def test_a_narrow_batch_is_refused_or_keeps_what_is_stored(spark, tmp_path):
    path = f"{tmp_path}/t"
    _stored_three(spark, path)
    narrow = spark.createDataFrame([(3, "a"), (1, "b")], "id long, part string")
    with pytest.raises(ValueError, match="lacks the columns .*extra"):
        upsert(narrow, path, ["id"], ["part"])
    schema = "id long, part string, extra string"
    assert rows(read_table(spark, path), "id", "extra") == [(1, "x"), (2, "y")]
    upsert(narrow, path, ["id"], ["part"], missing="keep")
    assert rows(spark.read.schema(schema).parquet(path), "id", "part", "extra") == [(1, "b", "x"), (2, "b", "y"), (3, "a", None)]


def test_a_wide_batch_adds_a_column(spark, tmp_path):
    path = f"{tmp_path}/t"
    _stored_three(spark, path)
    upsert(spark.createDataFrame([(2, "b", "z", 7), (4, "c", "w", 8)], "id long, part string, extra string, n int"), path, ["id"], ["part"])
    schema = "id long, part string, extra string, n int"
    assert rows(spark.read.schema(schema).parquet(path), "id", "extra", "n") == [(1, "x", None), (2, "z", 7), (4, "w", 8)]
    upsert(spark.createDataFrame([(4, "c", "v")], "id long, part string, extra string"), path, ["id"], ["part"], missing="keep")
    assert rows(spark.read.schema(schema).parquet(path), "id", "extra", "n") == [(1, "x", None), (2, "z", 7), (4, "v", 8)]


def test_a_retyped_batch_takes_the_stored_types(spark, tmp_path):
    path = f"{tmp_path}/t"
    _stored_three(spark, path)
    upsert(spark.createDataFrame([("1", "a", 5)], "id string, part string, extra int"), path, ["id"], ["part"])
    stored = read_table(spark, path)
    assert stored.schema["id"].dataType.simpleString() == "bigint"
    assert rows(stored, "id", "extra") == [(1, "5"), (2, "y")]


def test_replacing_some_partitions_leaves_the_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "n long, part string")
    replace_table(df, path, ["part"])
    replace_table(df.filter("part = 'b'").withColumn("n", F.col("n") * 10), path, ["part"], [("b",), ("c",)])
    assert rows(spark.read.schema("n long, part string").parquet(path)) == [(1, "a"), (20, "b")]
    replace_table(df.limit(0), path, ["part"])
    assert rows(spark.read.schema("n long, part string").parquet(path)) == []


def _scanned_rows(df) -> int:
    """Rows that the file scan of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("AdaptiveSparkPlan") else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def many_row_groups(spark, tmp_path):
    """A table of 20,000 even keys in one file of many small row groups, in key order."""
    path = str(tmp_path / "t")
    df = spark.range(20_000).select((F.col("id") * 2).alias("k"), F.concat(F.lit("name"), F.col("id") * 2).alias("name"), F.lit("p").alias("p"))
    writer = tables._writer(tables._clustered(df.repartition(1), (), ("k",)), (), ("k", "name"))
    writer.option("parquet.block.size", 16 * 1024).option("parquet.page.size", 1024).option("parquet.enable.dictionary", "false").parquet(path)
    return path


@pytest.mark.parametrize("keys, most", [([10_000], 1500), ([10_001], 0), ([4, 20_000, 39_998], 4500), ([1, 20_001, 39_997], 0)])
def test_a_few_keys_are_looked_up_in_the_row_groups_that_know_them(spark, many_row_groups, keys, most):
    stored = spark.read.parquet(many_row_groups)
    batch = spark.createDataFrame([(k,) for k in keys], "k long")
    facts = tables._batch_facts(batch, ["k"], False)
    found = stored.filter(tables.key_filter(batch, facts))
    assert _scanned_rows(found) <= most
    assert sorted(r["k"] for r in found.collect()) == [k for k in keys if k % 2 == 0]


def test_text_keys_are_looked_up_by_bloom_filter(spark, many_row_groups):
    """Names are not in text order, so minimum and maximum of a row group say little."""
    stored = spark.read.parquet(many_row_groups)
    batch = spark.createDataFrame([("name10000",), ("name10001",)], "name string")
    found = stored.filter(tables.key_filter(batch, tables._batch_facts(batch, ["name"], False)))
    assert _scanned_rows(found) <= 3000 and rows(found, "k") == [(10_000,)]


def test_scattered_keys_are_covered_by_ranges(spark, many_row_groups):
    keys = [*range(100, 300), *range(20_000, 20_200), 39_000]
    batch = spark.createDataFrame([(k,) for k in keys], "k long")
    facts = tables._batch_facts(batch, ["k"], False)
    ranges = tables._clusters(batch, "k", 100, 39_000)
    assert len(ranges) <= tables._RANGES and all(any(a <= k <= b for a, b in ranges) for k in keys)
    found = spark.read.parquet(many_row_groups).filter(tables.key_filter(batch, facts))
    assert _scanned_rows(found) < 6000
    assert set(k for k in keys if k % 2 == 0) <= {r["k"] for r in found.collect()}


def test_rows_lie_in_key_order_in_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5000).select(F.shuffle(F.sequence(F.lit(0), F.lit(9)))[0].alias("x"), (F.hash("id") % 100_000).alias("k"), (F.col("id") % 2).cast("string").alias("p")).dropDuplicates(["k"])
    tables.upsert(df, path, ["k"], ("p",))
    tables.upsert(df.limit(50).withColumn("x", F.lit(99)), path, ["k"], ("p",))
    stored = spark.read.parquet(path).select("k", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    previous = F.lag("k").over(Window.partitionBy("f").orderBy("i"))
    assert stored.withColumn("before", previous).filter("before > k").count() == 0


def test_changes_are_counted_by_group(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k long, g string, p string"
    first = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, None, "y")], schema)
    done = tables.upsert(first, path, ["k"], ("p",), count_by=("g", "p"), check_unique=False)
    assert rows(done.changes) == [("a", "x", 2), (None, "y", 1)]
    second = spark.createDataFrame([(1, "b", "x"), (3, None, "z"), (2, "a", "x"), (9, "a", "y")], schema)
    done = tables.upsert(second, path, ["k"], ("p",), count_by=("g", "p"))
    assert rows(done.changes) == sorted([("a", "x", -1), ("b", "x", 1), (None, "y", -1), (None, "z", 1), ("a", "y", 1)], key=repr)
    done = tables.upsert(second, path, ["k"], ("p",), count_by=("g", "p"))
    assert rows(done.changes) == []


def test_replacing_a_derived_table_drops_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "n long, p string"
    tables.replace_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema), path, ("p",))
    tables.replace_table(spark.createDataFrame([(4, "b"), (5, "c")], schema), path, ("p",))
    assert rows(tables.read_table(spark, path)) == [(4, "b"), (5, "c")]
    tables.replace_table(spark.createDataFrame([(6, "c")], schema), path, ("p",), [["b"], ["c"]])
    assert rows(tables.read_table(spark, path)) == [(6, "c")]

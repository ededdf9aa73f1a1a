"""Keyed tables: create-if-absent, read, and the idempotent upsert.

A table is named either by a catalog identifier (``lake.gold.fact_article``), where the
catalog's own MERGE does the work, or by a path holding partitioned Parquet, where the
touched partitions are rewritten. A path table has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F, types as T

from galley.functions.literals import empty_rows
from galley.operators.conform import conform
from galley.session import materialize, scratch_path
from galley.sources import files

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class UpsertResult:
    """What one upsert did."""

    created: bool
    batch_rows: int
    null_key_rows: int
    touched_partitions: int
    # Which ones, as folder names of each partition column; None where it is not known.
    partitions: tuple[tuple[str, ...], ...] | None = None
    # How many rows each group gained or lost, if that was asked for and is known.
    changes: DataFrame | None = None


def is_path(table: str) -> bool:
    return "/" in table


def table_exists(spark: SparkSession, table: str) -> bool:
    return files.exists(spark, table) if is_path(table) else spark.catalog.tableExists(table)


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_cols: Sequence[str] = ()
) -> bool:
    """Create an empty table unless it exists; True when it was created."""
    if table_exists(spark, table):
        return False
    _create(empty_rows(spark, schema), table, partition_cols)
    return True


def read_table(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; a path table is read with its declared schema, never an inferred one."""
    if not is_path(table):
        return spark.table(table)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(table)


def upsert(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_cols: Sequence[str] = (),
    newer_by: str | None = None,
    check_unique: bool = True,
    staged: bool = False,
    skip_unchanged: bool = False,
    schema: T.StructType | None = None,
    missing: str = "error",
    count_by: Sequence[str] = (),
) -> UpsertResult:
    """Matched keys take the batch row, new keys are added, other rows stay; nothing is deleted.

    Rows with a NULL key can never match and are dropped and counted. A key held by two batch
    rows is an error. With ``newer_by`` a batch row older than the stored one is ignored.
    ``check_unique=False`` is for batches that are unique by construction, ``staged`` for
    batches that only read stored files and need not be copied before they are used again.
    ``skip_unchanged`` first drops batch rows equal to the stored row, for batches that repeat
    most of the table: path partitions in which nothing changed are then not rewritten.

    The table's own columns and types hold: those declared in ``schema``, or else those stored.
    A batch that lacks a stored column is an error, as a full row cannot be replaced by part of
    one; ``missing="keep"`` fills the gap from the stored row instead (NULL for a new key). A
    column the table lacks is added to a path table, older rows having NULL, and is an error
    for a catalog table.

    ``count_by``: columns by which changed rows are counted: in ``changes`` of the result, which is
    staged, a stored row that was replaced counts -1 and one that was written +1 (path tables only).
    """
    if missing not in ("error", "keep"):
        raise ValueError("missing is 'error' or 'keep'")
    spark = df.sparkSession
    if is_path(table):
        finish_pending(spark, table)
    exists = table_exists(spark, table)
    if exists:
        fitted = _fitted(df, table, keys, partition_cols, schema, missing)
        # A batch filled up from the table reads what is about to be rewritten: it has to be copied.
        staged = staged and set(fitted.columns) <= set(df.columns)
        df = fitted
    if not exists and not check_unique:
        loaded = _load(df, table, keys, partition_cols)
        if not (count_by and is_path(table)):
            return loaded
        return replace(loaded, changes=_counted([(read_table(spark, table, df.schema), 1)], count_by))
    scratch = scratch_path(spark, "upsert")
    try:
        batch = df if staged else materialize(df, path=f"{scratch}/batch")
        facts = _batch_facts(batch, keys, check_unique)
        batch = batch.filter(_usable(keys))
        touched: list | None = [] if is_path(table) and exists else None
        changes = None
        if not exists:
            _create(_clustered(batch, partition_cols, keys), table, partition_cols, keys)
            if count_by and is_path(table):
                changes = _counted([(batch, 1)], count_by)
        elif is_path(table):
            if facts["rows"] > facts["nulls"]:
                touched, changes = _upsert_path(batch, table, keys, partition_cols, newer_by, skip_unchanged, facts, scratch, count_by)
        else:
            _merge(batch, table, keys, newer_by)
    finally:
        files.delete(spark, scratch)
    places = None if touched is None else tuple(map(tuple, touched))
    return UpsertResult(not exists, facts["rows"], facts["nulls"], len(touched or ()), places, changes)


def _counted(images: list[tuple[DataFrame, int]], count_by: Sequence[str]) -> DataFrame:
    """Rows gained (or lost) by group, staged: one row for each group that changed."""
    signed = [df.select(*count_by, F.lit(sign).cast("long").alias("change")) for df, sign in images]
    summed = reduce(DataFrame.unionAll, signed).groupBy(*count_by).agg(F.sum("change").alias("change"))
    return materialize(summed.filter("change <> 0"), "changes")


def _fitted(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    schema: T.StructType | None,
    missing: str,
) -> DataFrame:
    """The batch with the columns and types of the stored table."""
    spark = df.sparkSession
    if schema is None:
        # Nothing is declared: the files tell, all of them, as a later batch may have added a column.
        schema = _stored_schema(spark, table) or df.schema
        # Folder names carry no types: the batch tells those of the partition columns.
        typed = {c: df.schema[c] for c in partition_cols if c in df.columns}
        schema = T.StructType([typed.get(f.name, f) for f in schema.fields])
    added = [f for f in df.schema.fields if f.name not in schema.names]
    if added and not is_path(table):
        raise ValueError(f"{table} has no columns {[f.name for f in added]}")
    absent = [c for c in schema.names if c not in df.columns]
    if absent and missing == "error":
        raise ValueError(f"the batch for {table} lacks the columns {absent}")
    if absent:
        kept = read_table(spark, table, schema if is_path(table) else None).select(*keys, *absent)
        df = df.join(kept, list(keys), "left")
    return conform(df, T.StructType([*schema.fields, *added]))


def _stored_schema(spark: SparkSession, table: str) -> T.StructType | None:
    if not is_path(table):
        return spark.table(table).schema
    if not files.matching(spark, f"{table}/[!_.]*"):
        return None
    return spark.read.option("mergeSchema", True).parquet(table).schema


def _load(df: DataFrame, table: str, keys: Sequence[str], partition_cols: Sequence[str]) -> UpsertResult:
    """First load of rows known to be unique: one pass, the counts riding along.

    They are taken above the last shuffle, since AQE drops a stage, and what it observed,
    when the stage turns out empty.
    """
    seen, usable = Observation(), _usable(keys)
    counted = _clustered(df, partition_cols, keys).observe(
        seen, F.count("*").alias("rows"), F.count_if(~usable).alias("nulls")
    )
    _create(counted.filter(usable), table, partition_cols, keys)
    return UpsertResult(True, seen.get["rows"], seen.get["nulls"], 0)


def _usable(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _batch_facts(batch: DataFrame, keys: Sequence[str], check_unique: bool) -> dict:
    """Row count, NULL-key count, and the range of every number, date or text key, in one row.

    Counting per key first also shows whether a key repeats; copies of a key are added up
    before the shuffle, so one key in most of the rows does no harm.
    """
    ranged = [k for k in keys if isinstance(batch.schema[k].dataType, (T.NumericType, T.DateType, T.StringType))]
    if check_unique:
        per_key = batch.groupBy(*keys).agg(F.count("*").alias("_n"))
    else:
        per_key = batch.select(*keys, F.lit(1).cast("long").alias("_n"))
    usable = _usable(keys)
    row = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~usable, F.col("_n"))), F.lit(0)).alias("nulls"),
        F.max(F.when(usable, F.col("_n"))).alias("most"),
        *[F.struct(F.min(k).alias("low"), F.max(k).alias("high")).alias(f"range_{k}") for k in ranged],
    ).first()
    if (row["most"] or 0) > 1:
        repeated = per_key.filter(usable & (F.col("_n") > 1)).limit(5).collect()
        shown = ", ".join(str(tuple(r[k] for k in keys)) for r in repeated)
        raise ValueError(f"batch holds several rows for one key {tuple(keys)}: {shown}")
    return {"rows": row["rows"], "nulls": row["nulls"], "ranges": {k: row[f"range_{k}"] for k in ranged}}


def _create(df: DataFrame, table: str, partition_cols: Sequence[str], keys: Sequence[str] = ()) -> None:
    if is_path(table):
        _writer(df, partition_cols, keys).parquet(table)
    elif partition_cols:
        df.writeTo(table).partitionedBy(*map(F.col, partition_cols)).create()
    else:
        df.writeTo(table).create()


def _writer(df: DataFrame, partition_cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrameWriter:
    """A writer that keeps, beside the usual minimum and maximum, a Bloom filter of each key column by row group.

    Filters are sized to what a row group holds; Parquet leaves them out where a dictionary tells the same.
    """
    out = df.write.partitionBy(*partition_cols)
    for k in keys:
        if k not in partition_cols:
            out = out.option(f"parquet.bloom.filter.enabled#{k}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{k}", "true")
    return out.option("parquet.bloom.filter.adaptive.enabled", "true")


def replace_table(
    df: DataFrame, table: str, partition_cols: Sequence[str] = (), only: Sequence[Sequence[str]] | None = None
) -> None:
    """Store ``df`` as the whole content of a derived table; it must not be computed from it.

    ``only`` names partitions of an existing path table by their values: ``df`` is then the
    content of those, and the others stay. Partitions are replaced by Spark's own dynamic
    overwrite when the write commits; those that hold nothing any more are removed after that.
    """
    spark, laid_out = df.sparkSession, _clustered(df, partition_cols)
    if not is_path(table):
        out = laid_out.writeTo(table)
        (out.partitionedBy(*map(F.col, partition_cols)) if partition_cols else out).createOrReplace()
    elif not files.exists(spark, table):
        _create(laid_out, table, partition_cols)
    elif not partition_cols:
        laid_out.write.mode("overwrite").parquet(table)
    else:
        finish_pending(spark, table)
        if only is None:
            before = set(files.folders_below(spark, table, len(partition_cols)))
        else:
            before = {files.partition_folder(spark, partition_cols, v) for v in only}
        seen = Observation()
        # Folder names only: few beside the rows.
        filled = F.collect_set(F.struct(*[_folder_value(c).alias(c) for c in partition_cols])).alias("filled")
        laid_out = laid_out.observe(seen, F.count("*").alias("rows"), filled)
        laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(table)
        after = {files.partition_folder(spark, partition_cols, list(v)) for v in seen.get["filled"]} if seen.get["rows"] else set()
        for folder in before - after:
            files.delete(spark, f"{table}/{folder}")


def _clustered(df: DataFrame, partition_cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Bring each partition's rows together so few files are written, in the order of their keys.

    A rebalance, unlike a plain repartition, lets AQE cut a partition value that holds too
    many rows into several tasks and join small ones into one. Rows in key order give row
    groups and pages narrow key ranges, so that a lookup of some keys skips most of them.
    """
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    order = [*partition_cols, *[k for k in keys if k not in partition_cols]]
    return df.sortWithinPartitions(*order) if keys else df


def _merge(batch: DataFrame, table: str, keys: Sequence[str], newer_by: str | None) -> None:
    """MERGE on a row-level catalog."""
    pairs = [F.col(f"{table}.{k}") == F.col(f"batch.{k}") for k in keys]
    merge = batch.alias("batch").mergeInto(table, reduce(lambda a, b: a & b, pairs))
    if newer_by:
        stored = F.col(f"{table}.{newer_by}")
        matched = merge.whenMatched(stored.isNull() | (F.col(f"batch.{newer_by}") >= stored))
    else:
        matched = merge.whenMatched()
    matched.updateAll().whenNotMatched().insertAll().merge()


def _upsert_path(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_cols: Sequence[str],
    newer_by: str | None,
    skip_unchanged: bool,
    facts: dict,
    scratch: str,
    count_by: Sequence[str] = (),
) -> tuple[list[list[str]], DataFrame | None]:
    """Rewrite only the partitions the batch lands in or takes rows out of.

    A row may move to another date, so the stored place of every batch key is looked up
    first, in a scan of key and partition columns alone. When the partition columns are
    part of the key a match cannot lie elsewhere, and only the batch's partitions are scanned.
    """
    spark = batch.sparkSession

    def only_new() -> DataFrame | None:
        return _counted([(batch, 1)], count_by) if count_by else None

    if partition_cols and not files.folders_below(spark, table, len(partition_cols)):
        changes = only_new()
        return _append(batch, table, partition_cols, keys, _partitions(batch, partition_cols)), changes
    stored = spark.read.schema(batch.schema).parquet(table)
    lookup = stored.filter(key_filter(batch, facts))
    at_home = F.lit(True)
    if partition_cols and (skip_unchanged or set(partition_cols) <= set(keys)):
        at_home = _in_partitions(partition_cols, _partitions(batch, partition_cols))
    if skip_unchanged:
        batch = materialize(_changed(batch, lookup.filter(at_home), keys), path=f"{scratch}/changed")
        if batch.isEmpty():
            return [], only_new()
    if set(partition_cols) <= set(keys):
        lookup = lookup.filter(at_home)
    batch_keys = batch.select(*keys)
    place = list(dict.fromkeys([*keys, *partition_cols, *([newer_by] if newer_by else [])]))
    hits = lookup.select(*place).join(batch_keys, list(keys), "left_semi")
    if newer_by:
        hits = materialize(hits, path=f"{scratch}/hits")
        known = hits.select(*keys, F.col(newer_by).alias("_stored"))
        fresh = F.col("_stored").isNull() | (F.col(newer_by) >= F.col("_stored"))
        batch = materialize(
            batch.join(known, list(keys), "left").filter(fresh).select(*batch.columns), path=f"{scratch}/fresh"
        )
        batch_keys = batch.select(*keys)
        hits = hits.join(batch_keys, list(keys), "left_semi")
    touched = []
    if partition_cols:
        touched = _partitions(batch.select(*partition_cols).union(hits.select(*partition_cols)), partition_cols)
        if not touched:
            return [], only_new()
        if not any(files.exists(spark, f"{table}/{files.partition_folder(spark, partition_cols, v)}") for v in touched):
            changes = only_new()
            return _append(batch, table, partition_cols, keys, touched), changes
        stored = stored.filter(_in_partitions(partition_cols, touched))
    changes = None
    if count_by:
        changes = _counted([(stored.join(batch_keys, list(keys), "left_semi"), -1), (batch, 1)], count_by)
    merged = stored.join(batch_keys, list(keys), "left_anti").unionByName(batch)
    prepared = _beside(table, "_prepared")
    _writer(_clustered(merged, partition_cols, keys), partition_cols, keys).mode("overwrite").parquet(prepared)
    _publish(spark, table, partition_cols, [files.partition_folder(spark, partition_cols, v) for v in touched] or [""])
    return touched, changes


# Up to so many keys are looked up one by one, by Bloom filter; more of them as ranges, so many at most.
_POINTS, _RANGES, _CELLS = 64, 32, 1024


def key_filter(batch: DataFrame, facts: dict) -> Column:
    """A condition on the key columns that every row of the batch meets, for Parquet to skip row groups by.

    A few keys are named one by one; row groups whose Bloom filters know none of them are not
    read. Otherwise whole-number keys that lie scattered are covered by some ranges around
    their clusters, as one range from the oldest to the newest would cover the whole table.
    """
    tests = []
    for k, r in facts["ranges"].items():
        if r["low"] is None:
            continue
        test = F.col(k).between(F.lit(r["low"]), F.lit(r["high"]))
        if r["low"] == r["high"]:
            test = F.col(k) == F.lit(r["low"])
        elif facts["rows"] <= _POINTS:
            values = sorted(row[0] for row in batch.select(k).distinct().collect())
            test = _any([F.col(k) == F.lit(v) for v in values])
        elif isinstance(batch.schema[k].dataType, T.IntegralType) and r["high"] - r["low"] > 4 * facts["rows"]:
            test = _any([F.col(k).between(F.lit(a), F.lit(b)) for a, b in _clusters(batch, k, r["low"], r["high"])])
        tests.append(test)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _any(tests: list[Column]) -> Column:
    """One of the tests, as a balanced tree: a long chain would be a deep plan."""
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def _clusters(batch: DataFrame, key: str, low: int, high: int) -> list[tuple[int, int]]:
    """Ranges that hold every key of the batch, divided at the widest gaps; at most ``_CELLS`` rows are looked at."""
    width = -(-(high - low + 1) // _CELLS)
    cell = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).alias("cell")
    held = batch.groupBy(cell).agg(F.min(key).alias("a"), F.max(key).alias("b")).orderBy("cell").collect()
    gaps = sorted(range(1, len(held)), key=lambda i: held[i - 1]["b"] - held[i]["a"])[: _RANGES - 1]
    cuts = [0, *sorted(gaps), len(held)]
    return [(held[i]["a"], held[j - 1]["b"]) for i, j in zip(cuts, cuts[1:])]


def _append(
    batch: DataFrame, table: str, partition_cols: Sequence[str], keys: Sequence[str], touched: list[list[str]]
) -> list[list[str]]:
    """Rows for partitions that do not exist yet: nothing stored has to be read or moved."""
    _writer(_clustered(batch, partition_cols, keys), partition_cols, keys).mode("append").parquet(table)
    return touched


def _publish(spark: SparkSession, table: str, partition_cols: Sequence[str], folders: list[str]) -> None:
    """Put the prepared folders in place of ``folders``."""
    filled = files.folders_below(spark, _beside(table, "_prepared"), len(partition_cols))
    note = {"replace": filled, "empty": sorted(set(folders) - set(filled))}
    files.write_text(spark, _beside(table, "_pending"), json.dumps(note))
    finish_pending(spark, table)


def _changed(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows that are new, or differ from the stored row in some column."""
    b, s = batch.alias("b"), stored.alias("s")
    same = [
        F.col(f"b.{c}") == F.col(f"s.{c}") if c in keys else F.col(f"b.{c}").eqNullSafe(F.col(f"s.{c}"))
        for c in batch.columns
    ]
    unchanged = s.join(b, reduce(lambda x, y: x & y, same)).select(*[F.col(f"b.{k}") for k in keys])
    return batch.join(unchanged, list(keys), "left_anti").select(*batch.columns)


def _folder_value(column: str) -> Column:
    """A partition value as Spark names its folder; NULL and '' share one."""
    return F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(_NULL_PARTITION))


def _label(partition_cols: Sequence[str]) -> Column:
    """One text per partition; an expression of partition columns only, so it prunes files."""
    return F.concat_ws("/", *map(_folder_value, partition_cols))


def _in_partitions(partition_cols: Sequence[str], partitions: list[list[str]]) -> Column:
    return _label(partition_cols).isin(["/".join(values) for values in partitions])


def _partitions(df: DataFrame, partition_cols: Sequence[str]) -> list[list[str]]:
    """The partitions named in ``df``: folder names, never data rows."""
    names = [_folder_value(c).alias(c) for c in partition_cols]
    return sorted(list(row) for row in df.select(*names).distinct().toLocalIterator())


def _beside(table: str, prefix: str) -> str:
    """A name next to the table on the same file system, which readers of the layer skip."""
    parent, _, name = table.rstrip("/").rpartition("/")
    return f"{parent}/{prefix}_{name}"


def finish_pending(spark: SparkSession, table: str) -> bool:
    """Publish a prepared upsert, whether just written or left by a driver that died.

    The prepared folders are complete before the note naming them is written, and each is
    moved as a whole, so an interrupted publication is finished by calling this again. A
    partition that lost all its rows is removed, else a row that moved would be left in it.
    """
    note_path, prepared = _beside(table, "_pending"), _beside(table, "_prepared")
    if not files.exists(spark, note_path):
        return False
    note = json.loads(files.read_text(spark, note_path))
    files.replace(spark, prepared, table, note["replace"])
    for folder in note["empty"]:
        files.delete(spark, f"{table}/{folder}")
    files.delete(spark, note_path)
    files.delete(spark, prepared)
    return True

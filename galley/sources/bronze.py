"""The raw layer: Parquet partitioned by content type and ingestion date."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from galley.functions.dates import on_date, parse_run_date, with_date_parts
from galley.functions.literals import constant_rows, empty_rows
from galley.operators.conform import conform, union_all
from galley.schemas import BRONZE_CONTENT, BRONZE_INFO, BRONZE_PARTS, DATE_PARTS
from galley.sources import files

# The folder below a day that holds what one load of that day wrote.
LOAD = "load"
# How Spark names the folder of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_INSPECT_COLUMNS = ("id", "content_type", "version", "news_sites", "year", "month", "day")


def split_info(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(content, info) rows, the type compared without regard to case; a NULL type is content."""
    is_info = F.lower(F.coalesce("content_type", F.lit(""))) == "info"
    return records.filter(~is_info), records.filter(is_info)


def fill_info(info: DataFrame) -> DataFrame:
    """Missing id becomes 0, a missing or empty type becomes info, other missing text ''."""
    present = set(info.columns)
    filled = {
        "id": F.coalesce("id", F.lit(0).cast("long")) if "id" in present else F.lit(0).cast("long"),
        "content_type": F.coalesce(F.nullif(F.col("content_type"), F.lit("")), F.lit("info")),
        "version": F.coalesce("version", F.lit("")) if "version" in present else F.lit(""),
    }
    if "news_sites" in present:
        empty = F.array().cast("array<string>") if isinstance(info.schema["news_sites"].dataType, T.ArrayType) else F.lit("")
        filled["news_sites"] = F.coalesce("news_sites", empty)
    return info.withColumns(filled)


def nested_as_json(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Array and struct columns written out as JSON text, for stores that hold flat columns."""
    nested = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ArrayType, T.StructType)) and (columns is None or f.name in columns)
    ]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def append_partitioned(df: DataFrame, path: str, partition_cols: tuple[str, ...] = BRONZE_PARTS) -> int:
    """Add rows as new files beside the old ones; returns the rows written.

    The count rides along with the write. The rebalance keeps a day's files few and lets
    AQE divide the type that holds most of the rows.
    """
    seen = Observation()
    counted = df.hint("rebalance", *partition_cols).observe(seen, F.count("*").alias("rows"))
    counted.write.mode("append").partitionBy(*partition_cols).parquet(path)
    return seen.get["rows"]


def replace_load(df: DataFrame, path: str, run_date: tuple[str, str, str], load: str) -> int:
    """Store the rows as the whole of one load of a day: what it wrote before is replaced; returns the rows written.

    Spark's own dynamic overwrite replaces each type's folder as a whole when the write commits. A
    type that the load held before and holds no longer is removed after that. Other loads stay.
    """
    spark = df.sparkSession
    before = files.matching(spark, f"{path.rstrip('/')}/content_type=*/{day_folder(run_date)}/{LOAD}={load}")
    seen = Observation()
    kind = F.coalesce(F.nullif(F.col("content_type"), F.lit("")), F.lit(NO_VALUE))
    counted = df.withColumn(LOAD, F.lit(load)).hint("rebalance", *BRONZE_PARTS)
    counted = counted.observe(seen, F.count("*").alias("rows"), F.collect_set(kind).alias("types"))
    (
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BRONZE_PARTS, LOAD).parquet(path)
    )
    for folder in before:  # one for each type
        if unquote(folder.rpartition("content_type=")[2].split("/")[0]) not in seen.get["types"]:
            files.delete(spark, folder)
    return seen.get["rows"]


def write_bronze(
    items: DataFrame | None,
    info: DataFrame | None,
    path: str,
    ingestion_date: str | dt.date | None = None,
    content_schema: T.StructType = BRONZE_CONTENT,
    load: str | None = None,
) -> int:
    """Store one run's items and info record under its ingestion date (default: today, UTC).

    Info records among the items keep their version and site list: they are written as info.
    Without ``load`` the rows are added to the day's folder, beside all others. A named load of a date is stored once:
    running it again replaces what it wrote, and loads of other names stay. Items and records are
    loads of their own, so either can be written without the other.
    """
    run_date = parse_run_date(ingestion_date or dt.datetime.now(dt.timezone.utc).date())
    if load is not None and not re.fullmatch(r"[\w.-]+", load):
        raise ValueError(f"the name of a load holds letters, digits, dots and dashes, not {load!r}")

    def put(df: DataFrame, suffix: str = "") -> int:
        return append_partitioned(df, path) if load is None else replace_load(df, path, run_date, load + suffix)

    written = 0
    records = []
    if items is not None:
        # Only rows with a version or site list can be info records that would lose something.
        if {"version", "news_sites"} & set(items.columns):
            items, among = split_info(items)
            records.append(among)
        written += put(conform(with_date_parts(items, run_date), content_schema))
    if info is not None:
        records.append(info)
    if records:
        filled = [fill_info(r).withColumn("content_type", F.lit("info")) for r in records]
        shaped = union_all([conform(with_date_parts(f, run_date), BRONZE_INFO) for f in filled])
        written += put(shaped, "-record")
    return written


def day_folder(run_date: tuple[str, str, str] | None) -> str:
    return "/".join(f"{n}={v}" for n, v in zip(DATE_PARTS, run_date or "***"))


def read_bronze(
    spark: SparkSession,
    path: str,
    ingestion_date: str | dt.date | None = None,
    content_type: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Raw rows of one ingestion date (all dates if None) and optionally one type, of all its loads.

    Only the folders asked for are listed, let alone opened: a daily run does not walk the
    history. A date that was never loaded gives no rows. Days whose files lie in the day's folder
    itself, without loads, are read as well.
    """
    if schema is None:
        schema = BRONZE_INFO if content_type == "info" else BRONZE_CONTENT
    run_date = parse_run_date(ingestion_date)
    days = f"{path.rstrip('/')}/content_type={content_type or '*'}/{day_folder(run_date)}"
    loads = files.matching(spark, f"{days}/{LOAD}=*")
    held = files.matching(spark, f"{days}/*.parquet")
    # A day's folder as a whole, or its own files where loads lie in it too.
    mixed = {f.rpartition("/")[0] for f in loads}
    plain = sorted({f if f.rpartition("/")[0] in mixed else f.rpartition("/")[0] for f in held})
    frames = []
    for found in (loads, plain):
        if found:
            df = spark.read.schema(schema).option("basePath", path).parquet(*found).select(*schema.names)
            if run_date:
                df = df.filter(on_date(run_date))
            if content_type is not None:
                df = df.filter(F.col("content_type") == content_type)
            frames.append(df)
    return union_all(frames) if frames else empty_rows(spark, schema)


def inspect(
    df: DataFrame,
    columns: tuple[str, ...] = _INSPECT_COLUMNS,
    n: int = 50,
    order_by: tuple[str | Column, ...] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(schema, row count, first ``n`` rows) of those ``columns`` that exist, or all if none do.

    The rows are the first under ``order_by``; without it they are the first that a scan meets.
    """
    kept = [c for c in columns if c in df.columns] or df.columns
    shown = df.select(*kept)
    columns_shown = [(f.name, f.dataType.simpleString()) for f in shown.schema.fields]
    schema = constant_rows(df.sparkSession, columns_shown, "column string, type string")
    first = df.orderBy(*order_by).limit(n).select(*kept) if order_by else shown.limit(n)
    return schema, shown.agg(F.count("*").alias("row_count")), first

"""Landed JSON pages: one folder per endpoint, one page envelope per line or per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from galley.functions.literals import empty_rows
from galley.operators.conform import union_all
from galley.operators.intervals import coverage
from galley.schemas import INFO_RECORD, PAGE
from galley.sources import files

# Column that holds a page which is not valid JSON of the declared types.
RAW = "_raw"
# Endpoint folder to content type (fixed values).
CONTENT_TYPE_BY_ENDPOINT = {"articles": "article", "blogs": "blog", "reports": "report", "info": "info"}


def tag_type(
    df: DataFrame, endpoint: str = "endpoint", mapping: dict[str, str] = CONTENT_TYPE_BY_ENDPOINT
) -> DataFrame:
    """Add ``content_type`` from the endpoint a row came from; an unknown endpoint gives NULL."""
    pairs = [F.lit(text) for pair in mapping.items() for text in pair]
    return df.withColumn("content_type", F.create_map(*pairs)[F.col(endpoint)])


def _query_number(url: str, name: str) -> Column:
    return F.regexp_extract(url, rf"[?&]{name}=(\d+)", 1).try_cast("long")


def page_start() -> Column:
    """Position of a page's first item in its endpoint's listing, told by the neighbouring links."""
    from_next = _query_number("next", "offset") - _query_number("next", "limit")
    from_previous = F.coalesce(_query_number("previous", "offset"), F.lit(0)) + _query_number("previous", "limit")
    return F.coalesce(from_next, from_previous, F.lit(0).cast("long"))


def flatten_pages(pages: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per item of ``results``, with the total its page declared and its place in the listing."""
    spread = pages.select(
        *carry,
        F.col("count").alias("declared_total"),
        page_start().alias("_start"),
        F.posexplode("results").alias("_pos", "_item"),
    )
    return spread.select("_item.*", "declared_total", (F.col("_start") + F.col("_pos")).alias("arrival"), *carry)


def with_endpoint(schema: T.StructType) -> T.StructType:
    """The page schema plus the folder column."""
    return T.StructType([*schema.fields, T.StructField("endpoint", T.StringType())])


def with_raw_text(schema: T.StructType) -> T.StructType:
    """The page schema plus the text of a page that could not be read as declared."""
    return T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])


def read_envelopes(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PAGE,
    multi_line: bool = False,
    landed: str | None = None,
) -> DataFrame:
    """Content pages as they landed, each with its endpoint, its place and length in the listing (``start``,
    ``n_items``) and, where it cannot be read as declared, its raw text.

    Where ``path`` has no ``endpoint=<name>`` folders all pages are of one endpoint, NULL. Where
    those hold ``landed=<date>`` folders, ``landed`` names the day to read; the others are not listed.
    """
    root = path.rstrip("/")
    foldered = bool(files.matching(spark, f"{root}/endpoint=*"))
    full = with_raw_text(with_endpoint(schema) if foldered else schema)
    reader = spark.read.schema(full).option("multiLine", multi_line).option("columnNameOfCorruptRecord", RAW)
    days = files.matching(spark, f"{root}/endpoint=*/landed=*") if landed else []
    if days:
        asked = files.matching(spark, f"{root}/endpoint=*/landed={landed}")
        pages = reader.option("basePath", root).json(asked) if asked else empty_rows(spark, full)
    else:
        pages = reader.json(root)
    if not foldered:
        pages = pages.withColumn("endpoint", F.lit(None).cast("string"))
    size = F.when(F.col("results").isNotNull(), F.size("results"))
    return pages.withColumns({"start": page_start(), "n_items": size}).filter(F.coalesce(F.col("endpoint") != "info", F.lit(True)))


def readable() -> Column:
    """Whether an envelope has a list of items."""
    return F.col("n_items").isNotNull()


def broken_pages(envelopes: DataFrame) -> DataFrame:
    """``endpoint, reason, declared_total, page`` of every page that is not as declared; ``page`` is its text.

    A page that is cut off or no JSON is ``unreadable``; one without a list of items, such as an
    error message, has ``no results``. Of a page that is ``partly read`` the items are kept, with
    NULL in fields of another type than declared.
    """
    whole = F.to_json(F.struct("count", "next", "previous"))
    bad = F.col(RAW).isNotNull()
    reason = F.when(bad & readable(), "partly read").when(bad, "unreadable").otherwise("no results")
    return envelopes.filter(bad | ~readable()).select(
        "endpoint", reason.alias("reason"), F.col("count").alias("declared_total"), F.coalesce(RAW, whole).alias("page")
    )


def chain_gaps(envelopes: DataFrame) -> DataFrame:
    """``endpoint, kind, first, until``: places of each endpoint's listing that the pages do not hold exactly once.

    A page is the interval of places from its start on, as long as its list of items; the frame is
    the largest total that a page of the endpoint declares. ``missing`` places were never landed,
    ``repeated`` ones lie on two pages or more (the listing moved while it was read), ``beyond`` ones
    after the declared total. Unreadable pages hold nothing, so their places are missing.
    """
    pages = envelopes.filter(readable()).select("endpoint", "start", (F.col("start") + F.col("n_items")).alias("end"))
    totals = envelopes.filter(F.col("count").isNotNull()).groupBy("endpoint").agg(F.max("count").alias("end"))
    frames = totals.select("endpoint", F.lit(0).cast("long").alias("start"), "end")
    return coverage(pages, frames, ["endpoint"])


def items_of(envelopes: DataFrame) -> DataFrame:
    """Typed items of the content pages among the envelopes."""
    return tag_type(flatten_pages(envelopes.filter(readable()), ("endpoint",))).drop("endpoint")


def read_pages(
    spark: SparkSession,
    path: str,
    content_type: str | None = None,
    schema: T.StructType = PAGE,
    multi_line: bool = False,
    landed: str | None = None,
) -> DataFrame:
    """Items of all whole pages under ``path``; ``broken_pages`` tells the others.

    With ``content_type`` the path holds that type alone. Otherwise the path has
    ``endpoint=<name>`` folders and the type follows from the folder.
    ``multi_line`` is for one pretty-printed page per file; one page per line splits better.
    """
    envelopes = read_envelopes(spark, path, schema, multi_line, landed)
    if content_type is not None:
        return flatten_pages(envelopes.filter(readable())).withColumn("content_type", F.lit(content_type))
    return items_of(envelopes)


def read_info(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The metadata record: version and the official site list, as one info item."""
    record = spark.read.schema(INFO_RECORD).option("multiLine", multi_line).json(path)
    return info_item(record)


def info_item(record: DataFrame) -> DataFrame:
    """Shape a metadata record like an item: id 0, type info."""
    return record.select(
        F.lit(0).cast("long").alias("id"), F.lit("info").alias("content_type"), "version", "news_sites"
    )


def combine(items: list[DataFrame], info: DataFrame) -> DataFrame:
    """All endpoints and the info record in one frame; fields a type lacks are NULL."""
    return union_all([*items, info])

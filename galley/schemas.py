"""Declared schemas of every layer. Nothing is inferred from files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


STRING, LONG, BOOL, STAMP = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()

SOCIALS = _struct([(n, STRING) for n in ("x", "youtube", "instagram", "linkedin", "mastodon", "bluesky")])
AUTHOR = _struct([("name", STRING), ("socials", SOCIALS)])
LAUNCH = _struct([("launch_id", STRING), ("provider", STRING)])
EVENT = _struct([("event_id", T.IntegerType()), ("provider", STRING)])

# One shape for articles, blogs and reports; fields a type lacks are NULL.
ITEM = _struct(
    [
        ("id", LONG),
        ("title", STRING),
        ("url", STRING),
        ("image_url", STRING),
        ("news_site", STRING),
        ("summary", STRING),
        ("published_at", STRING),
        ("updated_at", STRING),
        ("featured", BOOL),
        ("authors", T.ArrayType(AUTHOR)),
        ("launches", T.ArrayType(LAUNCH)),
        ("events", T.ArrayType(EVENT)),
    ]
)
PAGE = _struct([("count", LONG), ("next", STRING), ("previous", STRING), ("results", T.ArrayType(ITEM))])
INFO_RECORD = _struct([("version", STRING), ("news_sites", T.ArrayType(STRING))])

DATE_PARTS = ("year", "month", "day")
_PARTS = [(name, STRING) for name in DATE_PARTS]

BRONZE_PARTS = ("content_type", *DATE_PARTS)
BRONZE_CONTENT = T.StructType(ITEM.fields + _struct([("content_type", STRING), *_PARTS]).fields)
BRONZE_INFO = _struct(
    [("id", LONG), ("version", STRING), ("news_sites", T.ArrayType(STRING)), ("content_type", STRING), *_PARTS]
)

INGESTION_PARTS = ("ingestion_year", "ingestion_month", "ingestion_day")
SILVER_CONTENT = T.StructType(
    [
        T.StructField(f.name, STAMP, True) if f.name in ("published_at", "updated_at") else f
        for f in ITEM.fields
    ]
    + _struct([("content_type", STRING), *[(n, STRING) for n in INGESTION_PARTS], *_PARTS]).fields
)
SILVER_INFO = _struct(
    [("id", LONG), ("content_type", STRING), ("version", STRING), ("news_site", STRING), *_PARTS]
)
KEYWORD = _struct([("term", STRING), ("score", T.DoubleType())])
ENTITY = _struct([("entity", STRING), ("kind", STRING), ("mentions", LONG)])
SILVER_ENRICHED = _struct(
    [
        ("content_type", STRING),
        ("id", LONG),
        ("published_at", STAMP),
        ("topic", STRING),
        ("keywords", T.ArrayType(KEYWORD)),
        ("entities", T.ArrayType(ENTITY)),
        *_PARTS,
    ]
)

WORD_STATS = _struct([("slot", STRING), ("term", STRING), ("df", LONG), ("before", LONG), ("batch", STRING)])
WORD_DELTA = _struct([("term", STRING), ("delta", LONG), ("batch", STRING)])

RUN_LOG = _struct(
    [("run_id", STRING), ("run_at", STAMP), ("status", STRING), ("phase", STRING), ("metric", STRING), ("value", LONG)]
)

DIM_NEWS_SOURCE = _struct([("news_source_id", LONG), ("news_site", STRING), ("version", STRING)])
DIM_TOPIC = _struct([("topic_id", STRING), ("topic_name", STRING)])
FACT_ARTICLE = _struct(
    [
        ("article_id", LONG),
        ("content_type", STRING),
        ("news_source_id", LONG),
        ("title", STRING),
        ("published_at", STAMP),
        ("updated_at", STAMP),
        *_PARTS,
    ]
)
AGG_TOPIC = _struct([("content_type", STRING), ("topic_name", STRING), *_PARTS, ("article_count", LONG)])
AGG_TOPIC_MONTH = _struct(
    [("content_type", STRING), ("topic_name", STRING), ("year", STRING), ("month", STRING), ("article_count", LONG)]
)
AGG_SOURCE_DAY = _struct([("news_site", STRING), *_PARTS, ("article_count", LONG)])
AGG_MONTH = _struct([("year", STRING), ("month", STRING), ("article_count", LONG)])
AGG_SOURCE = _struct([("news_site", STRING), ("year", STRING), ("month", STRING), ("article_count", LONG)])


def lists_as_text(schema: T.StructType) -> T.StructType:
    """The same columns with every list as text, as older raw layers hold them."""
    return T.StructType([T.StructField(f.name, STRING) if isinstance(f.dataType, T.ArrayType) else f for f in schema.fields])


@dataclass(frozen=True)
class Table:
    """A stored table: its schema, merge key and partitioning."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition_cols: tuple[str, ...] = field(default=())


CONTENT_KEY = ("content_type", "id")
# Silver table per content type, in the order the layers are reported.
CONTENT_TABLES = {"article": "articles", "blog": "blogs", "report": "reports"}

TABLES = {
    t.name: t
    for t in (
        *(Table(name, SILVER_CONTENT, CONTENT_KEY, DATE_PARTS) for name in CONTENT_TABLES.values()),
        Table("info", SILVER_INFO, ("news_site", *DATE_PARTS), DATE_PARTS),
        Table("enriched", SILVER_ENRICHED, CONTENT_KEY, DATE_PARTS),
        Table("dim_news_source", DIM_NEWS_SOURCE, ("news_site",)),
        Table("dim_topic", DIM_TOPIC, ("topic_id",)),
        Table("fact_article", FACT_ARTICLE, ("article_id", "content_type"), DATE_PARTS),
        Table("agg_topic_day", AGG_TOPIC, ("content_type", *DATE_PARTS), ("year", "month")),
        Table("agg_topic_month", AGG_TOPIC_MONTH, ("content_type", "year", "month"), ("year", "month")),
        Table("agg_source_day", AGG_SOURCE_DAY, ("news_site", *DATE_PARTS), ("year", "month")),
        Table("agg_month", AGG_MONTH, ("year", "month"), ("year", "month")),
        Table("agg_source_month", AGG_SOURCE, ("news_site", "year", "month"), ("year", "month")),
    )
}

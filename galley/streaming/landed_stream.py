"""Landed pages as a file stream, upserted batch by batch into the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from galley.operators.conform import split_by_value
from galley.plans import silver
from galley.plans.run import Layout, store
from galley.schemas import CONTENT_KEY, CONTENT_TABLES, PAGE
from galley.session import materialize, scratch_scope
from galley.sources.landed import flatten_pages, tag_type, with_endpoint


def stream_items(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New page files under ``landing`` as a stream of typed items."""
    reader = spark.readStream.schema(with_endpoint(PAGE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = reader.json(landing).filter((F.col("endpoint") != "info") & F.col("results").isNotNull())
    return tag_type(flatten_pages(pages, ("endpoint",))).drop("endpoint")


def new_versions(items: DataFrame, kept_for: str) -> DataFrame:
    """Drop items that came before in the same version, however many pages and batches ago.

    The state store keeps type, id, update time and a hash of all columns of what arrived within
    ``kept_for``. The watermark is on the time of arrival, so no item is ever late, however old.
    """
    version = F.xxhash64(F.to_json(F.struct(*items.columns)))
    marked = items.withColumns({"_arrived": F.current_timestamp(), "_version": version}).withWatermark("_arrived", kept_for)
    return marked.dropDuplicatesWithinWatermark([*CONTENT_KEY, "updated_at", "_version"]).drop("_arrived", "_version")


def upsert_stream(
    items: DataFrame, layout: Layout, ingestion_date: str, checkpoint: str, kept_for: str | None = "7 days"
) -> StreamingQuery:
    """Load everything that has landed since the last run, then stop.

    A batch replayed after a failure changes nothing: the upsert is idempotent, and an older
    version arriving late does not replace a newer one. Versions that came within ``kept_for``
    are dropped inside the stream, before the upsert (None: not at all); a batch, or a type in
    it, that holds nothing else touches no table.
    """
    # Where an item stands in a listing says nothing about its version.
    items = items.drop("declared_total", "arrival")
    if kept_for:
        items = new_versions(items, kept_for)

    def load(batch: DataFrame, _batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            cleaned = silver.stamp_ingestion(silver.clean_content(batch), ingestion_date)
            by_type = materialize(cleaned, "stream", partition_by=("content_type",))
            held = {r["content_type"] for r in by_type.select("content_type").distinct().collect()}
            tables = {kind: name for kind, name in CONTENT_TABLES.items() if kind in held}
            for name, df in split_by_value(by_type, "content_type", tables).items():
                store(df, layout, name, newer_by="updated_at", check_unique=False, staged=True)

    return (
        items.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

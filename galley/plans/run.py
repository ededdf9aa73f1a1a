"""The whole flow: which phases run, in what order, on which dates.

Two dates are kept apart. ``ingestion_date`` selects what was loaded on a day;
``published_date`` selects what was published on a day, whenever it was loaded.
"""

from __future__ import annotations

import argparse
import json
import uuid
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from galley.functions.dates import parse_run_date, parse_timestamp
from galley.functions.literals import empty_rows
from galley.operators.conform import conform, split_by_value, union_content
from galley.operators.dedup import first_per_key, sortable
from galley.operators.incremental import after_marks, high_water_marks
from galley.operators.quality import below_minimum, content_rules, layer_counts, quarantine
from galley.operators.quality import unknown_sources as unknown_sources_of
from galley.operators.ranking import cap_per_group
from galley.plans import content as text_analysis
from galley.plans import ledger, marts, silver, star
from galley.schemas import BRONZE_CONTENT, BRONZE_INFO, CONTENT_KEY, CONTENT_TABLES, DATE_PARTS, INGESTION_PARTS, TABLES, lists_as_text
from galley.session import configure, get_session, materialize, scratch_root, scratch_scope
from galley.sources import bronze, files, landed
from galley.sources.tables import (
    UpsertResult,
    finish_pending,
    is_path,
    read_table,
    replace_table,
    table_exists,
    upsert,
)

# Every phase, in the only order they can depend on each other.
PHASES = ("ingest", "silver", "content", "dims", "facts", "aggregates")
DEFAULT_PHASES = "silver,dims,facts"
_SILVER_NAMES = (*CONTENT_TABLES.values(), "info", "enriched", "item_terms", "word_stats", "word_delta", "word_items")


@dataclass(frozen=True)
class Layout:
    """Where the layers live.

    ``silver`` and ``gold`` are path prefixes or catalog namespaces; anything with a slash is
    a path. ``landing`` is needed by the ingest phase only, ``quarantine`` by nobody.
    """

    bronze: str
    silver: str
    gold: str
    landing: str | None = None
    quarantine: str | None = None

    def table(self, name: str) -> str:
        root = self.silver if name in _SILVER_NAMES else self.gold
        return f"{root.rstrip('/')}/{name}" if is_path(root) else f"{root}.{name}"


def parse_phases(text: str) -> tuple[str, ...]:
    """Comma list to phases in running order; a name that is not a phase is an error."""
    asked = [p.strip() for p in text.split(",") if p.strip()]
    unknown = sorted(set(asked) - set(PHASES))
    if unknown:
        raise ValueError(f"unknown phases {unknown}; known are {list(PHASES)}")
    return tuple(p for p in PHASES if p in asked)


def stored(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A stored table, or its empty shape when it was never written."""
    spec, where = TABLES[name], layout.table(name)
    if not table_exists(spark, where):
        return empty_rows(spark, spec.schema)
    return read_table(spark, where, spec.schema)


def store(df: DataFrame, layout: Layout, name: str, **options) -> UpsertResult:
    """Upsert into a table of the layout with its declared schema, key and partitioning."""
    spec = TABLES[name]
    schema = spec.schema if is_path(layout.table(name)) else None
    return upsert(conform(df, spec.schema), layout.table(name), spec.keys, spec.partition_cols, schema=schema, **options)


def only_new(spark: SparkSession, layout: Layout, items: DataFrame) -> DataFrame:
    """Landed items at or beyond the newest stored ones of their type."""
    marks = high_water_marks(published_content(spark, layout))
    texts = {c: F.col(f"_text_{c}") for c in ("published_at", "updated_at")}
    timed = items.withColumns({f"_text_{c}": F.col(c) for c in texts}).withColumns({c: parse_timestamp(c) for c in texts})
    return after_marks(timed, marks).withColumns(texts).select(*items.columns)


def ingest(
    spark: SparkSession,
    layout: Layout,
    ingestion_date: str,
    max_items: int | str | None = None,
    incremental: bool = False,
    load: str = "main",
    envelopes: DataFrame | None = None,
) -> dict[str, int]:
    """Landed pages to the raw layer; returns rows fetched, left after dedup, and written.

    Pages under ``landed=<date>`` folders are read for the ingestion date alone. All inputs are
    looked up before anything is written; without an info folder there is no info record.
    ``incremental`` takes only items at or beyond what the cleaned layer holds. A load of the same
    name and date that ran before is replaced; loads of other names stay. ``envelopes``: the pages,
    where they have been read already.
    """
    fetched, deduped = Observation(), Observation()
    count = F.count("*").alias("n")
    info_folder = f"{layout.landing.rstrip('/')}/endpoint=info"
    if days := files.matching(spark, f"{info_folder}/landed=*"):
        info_folder = next((d for d in days if d.endswith(f"landed={ingestion_date}")), f"{info_folder}/landed={ingestion_date}")
    info = landed.read_info(spark, info_folder) if files.exists(spark, info_folder) else None
    if envelopes is None:
        envelopes = landed.read_envelopes(spark, layout.landing, landed=ingestion_date)
    items = landed.items_of(envelopes)
    if incremental:
        items = only_new(spark, layout, items)
    items = cap_per_group(items, ["content_type"], ["arrival", *sortable(items, ["arrival", "content_type"])], max_items)
    items = items.observe(fetched, count)
    unique = first_per_key(items, CONTENT_KEY, ["arrival", *sortable(items, ["arrival", *CONTENT_KEY])])
    written = bronze.write_bronze(unique.observe(deduped, count), None, layout.bronze, ingestion_date, load=load)
    info_rows = bronze.write_bronze(None, info, layout.bronze, ingestion_date, load=load)
    # AQE drops an empty stage together with its counts; nothing written means nothing fetched.
    seen = (fetched.get["n"], deduped.get["n"]) if written else (0, 0)
    return {"fetched": seen[0] + info_rows, "deduped": seen[1] + info_rows, "written": written + info_rows}


def arrival(envelopes: DataFrame, layout: Layout, ingestion_date: str) -> dict[str, int]:
    """What of the landed listings did not arrive as it should.

    Counts ``broken_pages`` (no items could be read), ``partly_read`` pages, and places of the
    listings that are ``missing``, ``repeated`` or ``beyond`` the declared total. With a quarantine
    folder the pages and the ranges are kept there.
    """
    broken = landed.broken_pages(envelopes)
    gaps = materialize(landed.chain_gaps(envelopes), "gaps")
    partly = F.col("reason") == "partly read"
    pages = broken.agg(F.count_if(~partly).alias("broken_pages"), F.count_if(partly).alias("partly_read")).first().asDict()
    places = {r["kind"]: r["n"] for r in gaps.groupBy("kind").agg(F.sum(F.col("until") - F.col("first")).alias("n")).collect()}
    if layout.quarantine:
        root = layout.quarantine.rstrip("/")
        kept = {"pages": (broken, sum(pages.values())), "gaps": (gaps, len(places))}
        for name, (df, n) in kept.items():
            path = f"{root}_{name}/ingestion_date={ingestion_date}"
            if n or files.exists(df.sparkSession, path):
                df.write.mode("overwrite").parquet(path)
    return {**pages, **{kind: places.get(kind, 0) for kind in ("missing", "repeated", "beyond")}}


def silver_phase(
    spark: SparkSession, layout: Layout, ingestion_date: str, replace_newer: bool = False, raw_lists: str = "native"
) -> dict[str, UpsertResult | int]:
    """One ingestion day, cleaned, checked, and upserted into the table of each type.

    The deduplicated day is computed once and stored by type; each table then reads its own.
    A stored row that was updated later than the day's row stays, so a day can be run again at
    any time; ``replace_newer`` lets the day win. ``raw_lists="text"``: the raw layer holds nested
    columns as list text. ``unrouted`` counts the rows of no known type
    and ``unreadable_lists`` the info rows whose site list cannot be read; with a quarantine
    folder they are kept there.
    """
    as_text = raw_lists == "text"
    raw = bronze.read_bronze(spark, layout.bronze, ingestion_date, schema=lists_as_text(BRONZE_CONTENT) if as_text else None)
    raw = silver.with_native_lists(raw) if as_text else raw
    raw = raw.filter(F.lower(F.coalesce("content_type", F.lit(""))) != "info")
    cleaned = silver.clean_content(raw)
    if layout.quarantine:
        rules = content_rules(tuple(CONTENT_TABLES), "1900-01-01", "2999-12-31")
        cleaned = materialize(cleaned, "cleaned")
        cleaned, bad = quarantine(cleaned, rules)
        bad.write.mode("overwrite").parquet(f"{layout.quarantine.rstrip('/')}/ingestion_date={ingestion_date}")
    by_type = materialize(silver.stamp_ingestion(cleaned, ingestion_date), "by_type", partition_by=("content_type",))
    newer_by = None if replace_newer else "updated_at"
    results = {
        name: store(df, layout, name, newer_by=newer_by, check_unique=False, staged=True)
        for name, df in split_by_value(by_type, "content_type", CONTENT_TABLES).items()
    }
    known = F.coalesce(F.col("content_type").isin(*CONTENT_TABLES), F.lit(False))
    results["unrouted"] = raw.filter(~known).count()
    raw_info = bronze.read_bronze(spark, layout.bronze, ingestion_date, "info", lists_as_text(BRONZE_INFO) if as_text else None)
    unreadable = silver.unreadable_sites(raw_info)
    results["unreadable_lists"] = unreadable.count()
    if layout.quarantine and results["unreadable_lists"]:
        unreadable.write.mode("overwrite").parquet(f"{layout.quarantine.rstrip('/')}_info/ingestion_date={ingestion_date}")
    results["info"] = store(silver.clean_info(raw_info, ingestion_date), layout, "info", check_unique=False)
    return results


def published_content(spark: SparkSession, layout: Layout, published_date: str | None = None) -> DataFrame:
    """Articles, blogs and reports in one frame."""
    parts = {kind: stored(spark, layout, table) for kind, table in CONTENT_TABLES.items()}
    return union_content(parts, published_date)


def content_phase(
    spark: SparkSession,
    layout: Layout,
    gazetteer: DataFrame,
    rules: DataFrame,
    published_date: str | None = None,
) -> UpsertResult:
    """Keywords, entities and topic of every item, from its title and summary.

    Keywords are scored by statistics kept over all items ever analysed, not by those of the day.
    """
    docs = published_content(spark, layout, published_date)
    docs = docs.withColumn("text", F.concat_ws(" ", "title", "summary"))
    enriched = text_analysis.enrich(docs, CONTENT_KEY, "text", gazetteer, rules, ("published_at", *DATE_PARTS), place=layout.table)
    return store(enriched, layout, "enriched", check_unique=False)


def dims_phase(spark: SparkSession, layout: Layout) -> dict[str, UpsertResult]:
    """Source and topic dimensions; the source table exists afterwards even with no sites."""
    known = table_exists(spark, layout.table("dim_news_source"))
    current = stored(spark, layout, "dim_news_source") if known else None
    sources = star.build_source_dim(stored(spark, layout, "info"), current)
    return {
        "dim_news_source": store(sources, layout, "dim_news_source"),
        "dim_topic": store(star.build_topic_dim(spark), layout, "dim_topic"),
    }


def loaded_on(content: DataFrame, ingestion_date: str) -> Column:
    """Whether a cleaned row was loaded on that day."""
    day = parse_run_date(ingestion_date)
    return reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(INGESTION_PARTS, day)])


def facts_phase(
    spark: SparkSession, layout: Layout, published_date: str | None = None, ingestion_date: str | None = None
) -> UpsertResult:
    """Facts for one publication day, for what was loaded on one day, or for everything.

    With ``ingestion_date`` items whose source had no id so far are looked at again, as the
    dimension may know it by now. No rows still create the table.
    """
    content = published_content(spark, layout, published_date)
    sources = stored(spark, layout, "dim_news_source")
    incremental = published_date is None and ingestion_date is not None and table_exists(spark, layout.table("fact_article"))
    if incremental:
        loaded = loaded_on(content, ingestion_date)
        unnamed = stored(spark, layout, "fact_article").filter(F.col("news_source_id").isNull())
        unnamed = unnamed.select(F.col("article_id").alias("id"), "content_type")
        again = content.filter(F.col("news_site").isNotNull() & ~F.coalesce(loaded, F.lit(False)))
        again = again.join(unnamed, ["content_type", "id"], "left_semi").join(sources.select("news_site"), "news_site", "left_semi")
        content = content.filter(loaded).unionByName(again.select(*content.columns))
    facts = star.build_fact(content, sources)
    # A run over everything repeats nearly all stored facts; leave those where they are.
    full = published_date is None and not incremental
    options = {"skip_unchanged": full, "check_unique": False}
    if not is_path(layout.table("fact_article")):
        return store(facts, layout, "fact_article", **options)
    # Until the stored aggregates have followed, a note says for which months they are behind.
    begun = f"{_note(layout)}all"
    left = files.exists(spark, begun)  # by a run that died: all months stay behind
    if not left:
        files.write_text(spark, begun, "")
    done = store(facts, layout, "fact_article", **options, count_by=_COUNTED_BY)
    if done.partitions is not None:
        files.write_text(spark, f"{_note(layout)}{uuid.uuid4().hex}", json.dumps(sorted({p[:2] for p in done.partitions})))
        if not left:
            files.delete(spark, begun)
    return done


# What the stored aggregates count facts by.
_COUNTED_BY = ("news_source_id", "content_type", *DATE_PARTS)


def _note(layout: Layout) -> str:
    """How the notes begin that say which months the stored aggregates are behind in."""
    return f"{layout.gold.rstrip('/')}/_behind_"


def aggregates_phase(spark: SparkSession, layout: Layout, facts: UpsertResult | None = None) -> None:
    """Stored trend tables, kept up with the stored star.

    ``facts``: what the fact upsert of this run did. Its changes are added to the stored counts of
    the months touched. Where they are not known, or an earlier run has left months behind, those
    months are counted again from the star, all of them without a note.
    """
    fact = stored(spark, layout, "fact_article")
    topics, sources = stored(spark, layout, "dim_topic"), stored(spark, layout, "dim_news_source")
    tables = {
        "agg_month": marts.by_month,
        "agg_topic_day": lambda f: marts.by_topic_period(f, topics, marts.DAY),
        "agg_topic_month": lambda f: marts.by_topic_period(f, topics, marts.MONTH),
        "agg_source_day": lambda f: marts.by_source_period(f, sources, marts.DAY),
        "agg_source_month": lambda f: marts.by_source_month(f, sources),
    }
    notes = files.matching(spark, f"{_note(layout)}*") if is_path(layout.gold) else []
    notes = [n for n in notes if not n.endswith(".draft")]
    behind = [json.loads(files.read_text(spark, n)) for n in notes if not n.endswith("_all")]
    months = sorted({tuple(m) for listed in behind for m in listed})
    known = facts is not None and facts.partitions is not None and len(behind) == len(notes)
    # One note alone is that of this run's own upsert: its changes tell everything.
    by_changes = known and len(notes) == 1 and facts.changes is not None
    for name, build in tables.items():
        spec, where = TABLES[name], layout.table(name)
        if not known or not is_path(where) or not table_exists(spark, where):
            replace_table(conform(build(fact), spec.schema), where, spec.partition_cols)
        elif months:
            in_months = F.concat_ws("/", "year", "month").isin(["/".join(m) for m in months])
            if by_changes:
                summed = marts.with_changes(stored(spark, layout, name).filter(in_months), conform(build(facts.changes), spec.schema))
                content = materialize(conform(summed, spec.schema), "aggregate")
            else:
                content = conform(build(fact.filter(in_months)), spec.schema)
            replace_table(content, where, spec.partition_cols, months)
    for n in notes:
        files.delete(spark, n)


def counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows per layer and entity over everything stored."""
    raw = bronze.read_bronze(spark, layout.bronze, schema=BRONZE_CONTENT)
    raw_info = bronze.read_bronze(spark, layout.bronze, content_type="info", schema=BRONZE_INFO)
    layers = {("bronze", kind): raw.filter(F.col("content_type") == kind) for kind in CONTENT_TABLES}
    layers[("bronze", "info")] = raw_info
    layers |= {("silver", n): stored(spark, layout, n) for n in (*CONTENT_TABLES.values(), "info")}
    layers |= {("gold", n): stored(spark, layout, n) for n in ("dim_news_source", "dim_topic", "fact_article")}
    return layer_counts(layers)


def run(
    spark: SparkSession,
    layout: Layout,
    phases: str = DEFAULT_PHASES,
    ingestion_date: str | None = None,
    published_date: str | None = None,
    max_items: int | str | None = None,
    gazetteer: DataFrame | None = None,
    rules: DataFrame | None = None,
    incremental: bool = False,
    replace_newer: bool = False,
    full_facts: bool = False,
    load: str = "main",
    raw_lists: str = "native",
    minimum: dict[tuple[str, str], int] | None = None,
    unknown_sources: str = "mark",
    ledger_table: str | None = None,
) -> dict[str, object]:
    """Run the asked phases in order and return what each reported; with ``ingest`` comes ``arrival``.

    With an ingestion date the facts of that day's load are merged, all facts without one or
    with ``full_facts``. Aggregates after a fact phase are counted again for its months only.
    What a phase stages is deleted when the phase ends.

    ``raw_lists="text"`` reads a raw layer whose nested columns were stored as list text.
    ``minimum`` has least row counts by (layer, entity), held against the stored layers at the end.
    After the cleaning phase the items of unknown sources among the day's are counted:
    ``unknown_sources`` marks the run ("mark"), ends it ("stop"), or does not look ("ignore").
    Every run adds its numbers and how it ended to ``ledger_table`` (default: ``run_log`` of gold).
    """
    configure(spark)
    chosen = parse_phases(phases)
    if unknown_sources not in ("mark", "stop", "ignore") or raw_lists not in ("native", "text"):
        raise ValueError("unknown_sources is mark, stop or ignore; raw_lists is native or text")
    for date in (ingestion_date, published_date):
        parse_run_date(date)
    if {"ingest", "silver"} & set(chosen) and ingestion_date is None:
        raise ValueError("the ingest and silver phases need ingestion_date")
    if "ingest" in chosen and layout.landing is None:
        raise ValueError("the ingest phase needs a landing folder")
    if "content" in chosen and (gazetteer is None or rules is None):
        raise ValueError("the content phase needs a gazetteer and topic rules")
    for name in TABLES:
        if is_path(layout.table(name)):
            finish_pending(spark, layout.table(name))
    done: dict[str, object] = {}

    def pages() -> DataFrame:
        # Read once: the pages are looked at as items, as broken texts, and as intervals.
        envelopes = materialize(landed.read_envelopes(spark, layout.landing, landed=ingestion_date), "pages")
        done["arrival"] = arrival(envelopes, layout, ingestion_date)
        return envelopes

    steps = {
        "ingest": lambda: ingest(spark, layout, ingestion_date, max_items, incremental, load, pages()),
        "silver": lambda: silver_phase(spark, layout, ingestion_date, replace_newer, raw_lists),
        "content": lambda: content_phase(spark, layout, gazetteer, rules, published_date),
        "dims": lambda: dims_phase(spark, layout),
        "facts": lambda: facts_phase(spark, layout, published_date, None if full_facts else ingestion_date),
        "aggregates": lambda: aggregates_phase(spark, layout, done.get("facts")),
    }
    log, run_id, status = ledger_table or layout.table("run_log"), uuid.uuid4().hex, "failed"
    try:
        with ExitStack() as kept:
            for phase in chosen:
                # The changes that the fact upsert tells are staged, and read by the aggregates.
                if phase == "facts" and "aggregates" in chosen:
                    kept.enter_context(scratch_scope(spark))
                    done[phase] = steps[phase]()
                else:
                    with scratch_scope(spark):
                        done[phase] = steps[phase]()
                if phase == "silver" and unknown_sources != "ignore":
                    done["unknown_sources"] = {"items": unknown_items(spark, layout, ingestion_date)}
                    if done["unknown_sources"]["items"] and unknown_sources == "stop":
                        status = "stopped"
                        raise ledger.GateFailed(f"{done['unknown_sources']['items']} items of {ingestion_date} name a source that is not listed")
        if minimum:
            short = below_minimum(counts(spark, layout), minimum).orderBy("layer", "entity").collect()
            done["below_minimum"] = {f"{r['layer']}.{r['entity']}": r["row_count"] for r in short}
            if short:
                status = "stopped"
                raise ledger.GateFailed(f"fewer rows than the least allowed: {done['below_minimum']}")
        status = "marked" if done.get("unknown_sources", {}).get("items") else "ok"
    finally:
        ledger.record(spark, log, run_id, ledger.metrics(done), status)
    return done


def unknown_items(spark: SparkSession, layout: Layout, ingestion_date: str) -> int:
    """Items loaded on a day that name a source missing from all official lists stored so far."""
    loaded = published_content(spark, layout)
    loaded = loaded.filter(loaded_on(loaded, ingestion_date))
    return unknown_sources_of(loaded, stored(spark, layout, "info")).count()


def parse_catalogs(settings: list[str]) -> dict[str, dict[str, str]]:
    """``lake.impl=some.Class`` and the like, by catalog name."""
    catalogs: dict[str, dict[str, str]] = {}
    for text in settings:
        name, _, rest = text.partition(".")
        key, found, value = rest.partition("=")
        if not (name and key and found):
            raise ValueError(f"catalog setting {text!r} is not NAME.KEY=VALUE")
        catalogs.setdefault(name, {})[key] = value
    return catalogs


def parse_minimum(settings: list[str]) -> dict[tuple[str, str], int]:
    """``silver.articles=100`` and the like, by (layer, entity)."""
    out = {}
    for text in settings:
        place, found, n = text.partition("=")
        layer, dot, entity = place.partition(".")
        if not (layer and dot and entity and found and n.strip().isdecimal()):
            raise ValueError(f"least count {text!r} is not LAYER.ENTITY=N")
        out[layer, entity] = int(n)
    return out


def main(argv: list[str] | None = None) -> int:
    """Command line of the job; unknown arguments a launcher adds are ignored."""
    p = argparse.ArgumentParser(prog="galley", description=__doc__)
    for name in ("bronze", "silver", "gold"):
        p.add_argument(f"--{name}", required=True)
    for name in ("landing", "quarantine", "ingestion_date", "published_date", "max_items"):
        p.add_argument(f"--{name}")
    p.add_argument("--gazetteer", help="Parquet of (entity, kind)")
    p.add_argument("--rules", help="Parquet of (topic, term, weight)")
    p.add_argument("--phases", default=DEFAULT_PHASES, help=",".join(PHASES))
    p.add_argument("--catalog", action="append", default=[], metavar="NAME.KEY=VALUE", help="catalog setting; KEY impl names the class")
    p.add_argument("--raw_lists", default="native", choices=["native", "text"])
    p.add_argument("--unknown_sources", default="mark", choices=["mark", "stop", "ignore"])
    p.add_argument("--minimum", action="append", default=[], metavar="LAYER.ENTITY=N", help="least rows at the end; fewer fail the run")
    p.add_argument("--views", metavar="NAMESPACE", help="publish the marts as views there when the run has ended")
    p.add_argument("--load", default="main", help="name of the raw load; running it again replaces it")
    for name in ("incremental", "replace_newer", "full_facts"):
        p.add_argument(f"--{name}", action="store_true")
    args = p.parse_known_args(argv)[0]
    spark = get_session(catalogs=parse_catalogs(args.catalog))
    for namespace in (args.silver, args.gold):
        if not is_path(namespace):
            spark.sql("CREATE NAMESPACE IF NOT EXISTS " + ".".join(f"`{part}`" for part in namespace.split(".")))
    side_tables = {
        name: spark.read.parquet(path) if path else None
        for name, path in (("gazetteer", args.gazetteer), ("rules", args.rules))
    }
    layout = Layout(args.bronze, args.silver, args.gold, args.landing, args.quarantine)
    run(
        spark,
        layout,
        args.phases,
        args.ingestion_date,
        args.published_date,
        args.max_items,
        **side_tables,
        incremental=args.incremental,
        replace_newer=args.replace_newer,
        full_facts=args.full_facts,
        load=args.load,
        raw_lists=args.raw_lists,
        minimum=parse_minimum(args.minimum),
        unknown_sources=args.unknown_sources,
    )
    if args.views:
        from galley.plans.views import publish_views

        publish_views(spark, layout, args.views)
    files.delete(spark, scratch_root(spark))
    return 0

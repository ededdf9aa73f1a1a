"""Keywords, entities, topics and the enriched table over the document texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from galley.functions.dates import with_date_parts
from galley.functions.literals import constant_rows
from galley.plans import content as text_analysis
from galley.plans import word_stats
from galley.plans.content import STOP_WORDS
from galley.registry.base import query, table
from galley.session import materialize, scratch_path
from galley.sources.tables import read_table, upsert

_KEY = ("doc_id",)

# Rules that tell the corpus languages apart by common words: topic, term, weight (fixed values).
# One term is written with a capital letter: case does not count.
RULES = [
    ("english", "that", 2), ("english", "with", 1), ("english", "this", 1),
    ("french", "pour", 2), ("french", "dans", 1), ("french", "elle", 1),
    ("german", "nicht", 2), ("german", "sich", 1), ("german", "der", 1),
    ("spanish", "para", 2), ("spanish", "Los", 1), ("spanish", "como", 1),
]
_RULES = (
    "rules AS (SELECT topic, lower(word) AS term, weight FROM (VALUES "
    + ", ".join(map(str, RULES)) + ") AS t(topic, word, weight))"
)

# Host labels of the web pages stand for entities, their top-level domain for the kind.
_HOST = r"://(?:[a-z]+\.)?([a-z]+)\.example\.([a-z]+)"


def _gazetteer(spark, folder):
    url = F.col("url")
    return (
        table(spark, folder, "pages")
        .select(F.regexp_extract(url, _HOST, 1).alias("entity"), F.regexp_extract(url, _HOST, 2).alias("kind"))
        .filter(F.col("entity") != "")
        .distinct()
    )


_GAZETTEER = f"""gazetteer AS (
  SELECT DISTINCT regexp_extract(url, '{_HOST}', 1) AS entity, regexp_extract(url, '{_HOST}', 2) AS kind
  FROM pages WHERE regexp_extract(url, '{_HOST}', 1) <> '')"""

_TERMS = r"""terms AS (
  SELECT doc_id, term, COUNT(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents) GROUP BY ALL)"""
_KEYWORDS = f"""counts AS (
  SELECT * FROM terms WHERE length(term) >= 2 AND term NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})
), spread AS (SELECT term, COUNT(*) AS df FROM counts GROUP BY term
), scored AS (
  SELECT doc_id, term, ROUND(tf * ln((1.0 + (SELECT COUNT(*) FROM documents)) / (1.0 + df)), 6) AS score
  FROM counts JOIN spread USING (term)
), keywords AS (
  SELECT doc_id, CAST(ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS INTEGER) AS rank, term, score
  FROM scored QUALIFY rank <= 5)"""
_ENTITIES = """entities AS (
  SELECT doc_id, entity, kind, CAST(SUM(tf) AS BIGINT) AS mentions
  FROM terms JOIN gazetteer ON term = entity GROUP BY ALL)"""
_TOPICS = """topics AS (
  SELECT doc_id, COALESCE(topic, 'other') AS topic, COALESCE(weight, 0) AS weight FROM documents LEFT JOIN (
    SELECT doc_id, topic, CAST(SUM(tf * weight) AS BIGINT) AS weight FROM terms JOIN rules USING (term) GROUP BY doc_id, topic
    QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY SUM(tf * weight) DESC, topic) = 1) USING (doc_id))"""


def _with(*parts):
    return "WITH " + ", ".join(parts) + " "


def _docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def _rules(spark):
    return constant_rows(spark, RULES, "topic string, term string, weight long")


@query("c1_keywords", _with(_TERMS, _KEYWORDS) + "SELECT doc_id, rank, term, score FROM keywords")
def c1_keywords(spark, folder):
    return text_analysis.keywords(_docs(spark, folder), _KEY, "text")


@query("c1_incremental", _with(_TERMS, _KEYWORDS) + "SELECT doc_id, rank, term, score FROM keywords")
def c1_incremental(spark, folder):
    """Three batches, of which the first holds older texts of some items of the last: scored as in one run."""
    docs = _docs(spark, folder)
    third, updated = F.col("doc_id") % 3, F.col("doc_id") % 4 == 0
    older = docs.filter((third == 2) & updated).withColumn("text", F.concat(F.lit("formerly this "), F.substring("text", 1, 300)))
    root = scratch_path(spark, "words")
    for batch in (docs.filter(third == 0).union(older), docs.filter(third == 1), docs.filter(third == 2)):
        terms = text_analysis.term_counts(batch, _KEY, "text", 1)
        word_stats.learn(materialize(terms, "terms"), batch, _KEY, lambda name: f"{root}/{name}")
    stats = word_stats.stats(spark, lambda name: f"{root}/{name}")
    return text_analysis.keywords(docs, _KEY, "text", stats=stats)


@query("c2_entities", _with(_TERMS, _GAZETTEER, _ENTITIES) + "SELECT doc_id, entity, kind, mentions FROM entities")
def c2_entities(spark, folder):
    return text_analysis.entities(_docs(spark, folder), _KEY, "text", _gazetteer(spark, folder))


_OPENINGS = {"couple": 2, "line": 3, "verse": 6}


def _phrases(spark, folder):
    """Names of one word and of several: host labels, and the beginnings of every benchmark item."""
    items = spark.read.schema("item_id long, text string").parquet(f"{folder}/benchmark.parquet")
    written = F.split("text", " ")
    openings = [
        items.select(F.array_join(F.slice(written, 1, n), " ").alias("entity"), F.lit(kind).alias("kind")) for kind, n in _OPENINGS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), openings, _gazetteer(spark, folder)).distinct()


@query(
    "c2_entities_phrases",
    f"""WITH {_GAZETTEER}, written AS (SELECT string_split(text, ' ') AS w FROM benchmark
        ), given AS (
          SELECT * FROM gazetteer
          UNION SELECT array_to_string(w[1:2], ' '), 'couple' FROM written
          UNION SELECT array_to_string(w[1:3], ' '), 'line' FROM written
          UNION SELECT array_to_string(w[1:6], ' '), 'verse' FROM written
        ), names AS (
          SELECT DISTINCT entity, kind, regexp_extract_all(lower(entity), '\\p{{L}}+') AS w FROM given
        ), texts AS (
          SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS w FROM documents
        ), places AS (
          SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts
        ), runs AS (
          SELECT doc_id, array_to_string(w[i:i + n - 1], ' ') AS run, n
          FROM places, (SELECT DISTINCT len(w) AS n FROM names WHERE len(w) > 0) WHERE i + n - 1 <= len(w))
        SELECT doc_id, entity, kind, COUNT(*) AS mentions
        FROM runs JOIN names ON run = array_to_string(names.w, ' ') AND n = len(names.w) GROUP BY ALL""",
)
def c2_entities_phrases(spark, folder):
    """Names of two, three, six and more words beside names of one."""
    return text_analysis.entities(_docs(spark, folder), _KEY, "text", _phrases(spark, folder))


@query("c3_topic", _with(_TERMS, _RULES, _TOPICS) + "SELECT doc_id, topic, weight FROM topics")
def c3_topic(spark, folder):
    return text_analysis.topics(_docs(spark, folder), _KEY, "text", _rules(spark))


@query(
    "c4_enriched",
    _with(_TERMS, _KEYWORDS, _GAZETTEER, _ENTITIES, _RULES, _TOPICS)
    + """SELECT doc_id, topic, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
           (SELECT string_agg(k.term, ',' ORDER BY k.rank) FROM keywords k WHERE k.doc_id = d.doc_id) AS keywords,
           (SELECT string_agg(e.entity || ':' || e.kind || ':' || e.mentions, ',' ORDER BY e.entity, e.kind)
              FROM entities e WHERE e.doc_id = d.doc_id) AS entities
         FROM documents d JOIN topics USING (doc_id) LEFT JOIN orders ON o_orderkey = d.doc_id""",
)
def c4_enriched(spark, folder):
    """All three analyses per document, upserted into a table partitioned by month of publication."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    analysed = text_analysis.enrich(_docs(spark, folder), _KEY, "text", _gazetteer(spark, folder), _rules(spark))
    dated = with_date_parts(analysed.join(orders, "doc_id", "left"), "o_orderdate")
    enriched = dated.select("doc_id", "topic", "keywords", "entities", "year", "month")
    path = scratch_path(spark, "enriched")
    upsert(enriched, path, _KEY, ("year", "month"), check_unique=False)
    stored = read_table(spark, path, enriched.schema)
    entity = F.transform("entities", lambda e: F.concat_ws(":", e["entity"], e["kind"], e["mentions"].cast("string")))
    words = F.transform("keywords", lambda k: k["term"])
    return stored.select(
        "doc_id",
        "topic",
        "year",
        "month",
        F.when(F.col("keywords").isNotNull(), F.array_join(words, ",")).alias("keywords"),
        F.when(F.col("entities").isNotNull(), F.array_join(entity, ",")).alias("entities"),
    )

"""Text analysis of titles and summaries: keywords, entities, rule-based topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from galley.functions.text import words
from galley.operators.dedup import top_n_per_key
from galley.operators.joins import join_dimension
from galley.plans import word_stats
from galley.session import materialize

# English function words (fixed values).
STOP_WORDS = (
    "about", "after", "also", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from",
    "had", "has", "have", "he", "her", "his", "if", "in", "into", "is", "it", "its", "more", "no", "not",
    "of", "on", "or", "over", "she", "so", "than", "that", "the", "their", "them", "then", "there", "these",
    "they", "this", "to", "was", "we", "were", "what", "when", "which", "will", "with", "you",
)
# Single letters say nothing; names such as ESA or UN do.
MIN_LENGTH = 2


def term_counts(
    docs: DataFrame, key: Sequence[str], text: str, min_length: int = MIN_LENGTH
) -> DataFrame:
    """How often each word occurs in each document.

    A document's words leave its task already counted, so long texts shuffle as their
    vocabulary, not as their length.
    """
    tokens = docs.select(*key, F.explode(words(text, min_length)).alias("term"))
    return tokens.groupBy(*key, "term").agg(F.count("*").alias("tf"))


def keywords(
    docs: DataFrame,
    key: Sequence[str],
    text: str,
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    min_length: int = MIN_LENGTH,
    terms: DataFrame | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Top ``k`` words per document by tf * ln((1 + N) / (1 + df)), ties by word.

    Scores are compared at six decimals, the precision they are returned in. ``terms`` is a
    stored ``term_counts`` to use instead of reading the texts again. N and df are those of
    ``docs``, or the kept ones in ``stats`` (``word_stats.stats``), so that a batch is scored
    as part of everything seen.
    """
    if terms is None:
        terms = term_counts(docs, key, text, min_length)
    counts = terms.filter((F.length("term") >= min_length) & ~F.col("term").isin(*stop_words))
    if stats is None:
        # Counting on tf keeps both uses of the counted words alike, so Spark shuffles them once.
        spread = counts.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
        total = docs.agg(F.count("*").alias("n")).scalar()
    else:
        spread = stats.filter(F.col("term") != word_stats.ALL_ITEMS)
        total = stats.filter(F.col("term") == word_stats.ALL_ITEMS).agg(F.coalesce(F.max("df"), F.lit(0)).alias("n")).scalar()
    idf = spread.select("term", F.log((1 + total) / (1 + F.col("df"))).alias("idf"))
    # Six decimals in plain double arithmetic; round() would go through decimals on every row.
    score = F.rint(F.col("tf") * F.col("idf") * 1e6) / 1e6
    scored = counts.join(idf, "term").select(*key, "term", score.alias("score"))
    return top_n_per_key(scored, key, [F.desc("score"), "term"], k, "rank").select(*key, "rank", "term", "score")


def prefix_table(names: DataFrame) -> DataFrame:
    """The names (entity, kind, words) as a word trie in rows: ``prefix, depth, entity, kind, inner``.

    A node is the text of its words so far. It has a row for each name that ends there, or one
    without a name; ``inner`` tells whether longer names go on from it.
    """
    steps = names.select("entity", "kind", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("depth"))
    ends = F.col("depth") == F.size("words")
    nodes = steps.select(
        F.array_join(F.slice("words", F.lit(1), F.col("depth")), " ").alias("prefix"), "depth",
        F.when(ends, F.struct("entity", "kind")).alias("name"),
    )
    grouped = nodes.groupBy("prefix", "depth").agg(
        F.collect_set("name").alias("names"), F.bool_or(F.col("name").isNull()).alias("inner")
    )
    return grouped.select("prefix", "depth", "inner", F.explode_outer("names").alias("name")).select(
        "prefix", "depth", "name.entity", "name.kind", "inner"
    )


# First words of names up to which texts are filtered by a set sent with the plan.
_FIRST_WORDS = 20_000


def _places(docs: DataFrame, key: Sequence[str], text: str, first: DataFrame, length: int) -> DataFrame:
    """``key`` and ``from``: the ``length`` words from every place on whose word is in ``first`` (word).

    Only such places leave a text. Few first words are looked up in a set inside the scan;
    with many, the texts are joined with those of them that they hold.
    """
    tokens = docs.select(*key, words(text).alias("_words"))
    some = [r["word"] for r in first.limit(_FIRST_WORDS + 1).collect()]
    if len(some) <= _FIRST_WORDS:
        begins = lambda w: w.isin(some)
    else:
        held = tokens.select(*key, F.explode(F.array_distinct("_words")).alias("word"))
        held = join_dimension(held, first, "word", "left_semi").groupBy(*key).agg(F.collect_set("word").alias("_held"))
        tokens = tokens.join(held, list(key))
        begins = lambda w: F.array_contains("_held", w)
    numbered = F.transform("_words", lambda w, i: F.when(begins(w), i + 1))
    at = F.explode(F.array_compact(numbered)).alias("_at")
    return tokens.select(*key, "_words", at).select(*key, F.slice("_words", F.col("_at"), F.lit(length)).alias("from"))


def entities(
    docs: DataFrame,
    key: Sequence[str],
    text: str,
    gazetteer: DataFrame,
    terms: DataFrame | None = None,
) -> DataFrame:
    """Mentions per document of each (entity, kind) in the gazetteer, however many words a name has.

    Names are split into words as texts are. One-word names are looked up among the counted
    words. Longer ones form a word trie: places whose word begins one leave the text, and are
    walked down word by word; at each depth only places that lie on a node go on, so many names
    with the same beginning cost no more than one. Mentions may overlap each other.
    """
    names = gazetteer.select("entity", "kind", words("entity").alias("words")).filter(F.size("words") > 0).distinct()
    names = materialize(names, "names")
    if terms is None:
        terms = term_counts(docs, key, text, 1)
    single = names.filter(F.size("words") == 1).select(F.col("words")[0].alias("term"), "entity", "kind")
    found = join_dimension(terms, single, "term", "inner").select(*key, "entity", "kind", "tf")
    longer = names.filter(F.size("words") > 1)
    length = longer.agg(F.max(F.size("words"))).first()[0]
    if length:
        trie = materialize(prefix_table(longer), "trie")
        first = longer.select(F.col("words")[0].alias("word")).distinct()
        places = materialize(_places(docs, key, text, first, length), "places")
        for depth in range(2, length + 1):
            nodes = trie.filter(F.col("depth") == depth)
            reached = places.filter(F.size("from") >= depth).withColumn(
                "prefix", F.array_join(F.slice("from", F.lit(1), F.lit(depth)), " ")
            )
            ends = nodes.filter(F.col("entity").isNotNull()).select("prefix", "entity", "kind")
            hits = join_dimension(reached, ends, "prefix", "inner")
            found = found.unionByName(hits.select(*key, "entity", "kind", F.lit(1).cast("long").alias("tf")))
            if depth < length:
                inner = nodes.filter("inner").select("prefix").distinct()
                places = materialize(join_dimension(reached, inner, "prefix", "left_semi").select(*key, "from"), "places")
    return found.groupBy(*key, "entity", "kind").agg(F.sum("tf").alias("mentions"))


def rule_topics(terms: DataFrame, key: Sequence[str], rules: DataFrame) -> DataFrame:
    """Best (topic, weight) of each document that meets a rule: summed weights, ties by name.

    Rule terms are compared without regard to case; a term given twice for a topic counts twice.
    """
    folded = rules.groupBy("topic", F.lower("term").alias("term")).agg(F.sum("weight").alias("weight"))
    hits = join_dimension(terms, folded, "term", "inner")
    weights = hits.groupBy(*key, "topic").agg(F.sum(F.col("tf") * F.col("weight")).alias("weight"))
    return top_n_per_key(weights, key, [F.desc("weight"), F.col("topic")])


def topics(
    docs: DataFrame, key: Sequence[str], text: str, rules: DataFrame, other: str = "other"
) -> DataFrame:
    """Topic of every document; a document that meets no rule gets ``other`` with weight 0."""
    best = rule_topics(term_counts(docs, key, text, 1), key, rules)
    joined = docs.select(*key).join(best, list(key), "left")
    return joined.select(
        *key, F.coalesce("topic", F.lit(other)).alias("topic"), F.coalesce("weight", F.lit(0)).alias("weight")
    )


def enrich(
    docs: DataFrame,
    key: Sequence[str],
    text: str,
    gazetteer: DataFrame,
    rules: DataFrame,
    carry: Sequence[str] = (),
    k: int = 5,
    stop_words: Sequence[str] = STOP_WORDS,
    other: str = "other",
    min_length: int = MIN_LENGTH,
    place: word_stats.Place | None = None,
) -> DataFrame:
    """One row per document: its columns, topic, ranked keywords, and entities found.

    ``place`` names the tables of kept word statistics: they learn these documents first, and
    the keywords are scored by them. Without it the statistics are those of the documents given.

    The texts are split into counted words once, and that table is stored for the three
    analyses. The collected lists are short by construction: ``k`` keywords, and the
    distinct entities of one text.
    """
    terms = materialize(term_counts(docs, key, text, 1), "terms")
    stats = None
    if place is not None:
        word_stats.learn(terms, docs, key, place)
        stats = word_stats.stats(docs.sparkSession, place)
    ranked = keywords(docs, key, text, k, stop_words, min_length, terms, stats)
    top = ranked.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("rank", "term", "score"))).alias("_k"))
    keyword = F.transform("_k", lambda x: F.struct(x["term"].alias("term"), x["score"].alias("score")))
    top = top.select(*key, keyword.alias("keywords"))
    found = entities(docs, key, text, gazetteer, terms=terms).groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("entity", "kind", "mentions"))).alias("entities")
    )
    best = rule_topics(terms, key, rules).drop("weight")
    joined = docs.select(*key, *carry)
    for part in (best, top, found):
        joined = joined.join(part, list(key), "left")
    return joined.withColumn("topic", F.coalesce("topic", F.lit(other)))

import math
import re
from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from galley.plans import content
from galley.plans.content import STOP_WORDS

TEXTS = {
    1: "NASA launches Falcon; the Falcon rocket launches again with crew",
    2: "Rocket engines: engines, engines! Blue engines test",
    3: "",
    4: None,
    5: "Crew of four returns. NASA's crew rests after landing at Texas, Texas",
    6: "of to in",
}


def _docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(texts.items()), "id long, text string")


def brute_keywords(texts, k):
    counts = {d: Counter(w for w in re.findall(r"[^\W\d_]+", (t or "").lower()) if len(w) >= 2 and w not in STOP_WORDS) for d, t in texts.items()}
    spread = Counter(w for c in counts.values() for w in c)
    out = []
    for d, c in counts.items():
        scored = sorted(((-round(tf * math.log((1 + len(texts)) / (1 + spread[w])), 6), w) for w, tf in c.items()))
        out += [(d, i, w, -s) for i, (s, w) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def test_keywords_match_brute_force(spark):
    assert rows(content.keywords(_docs(spark), ["id"], "text", k=3)) == brute_keywords(TEXTS, 3)


def test_keywords_on_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    texts = {r["id"]: r["text"] for r in docs.collect()}
    assert rows(content.keywords(docs, ["id"], "text")) == brute_keywords(texts, 5)


def test_entities(spark):
    gazetteer = spark.createDataFrame([("NASA", "company"), ("Falcon", "vehicle"), ("Texas", "place"), ("Texas", "place"), ("texas", "ship")], "entity string, kind string")
    assert rows(content.entities(_docs(spark), ["id"], "text", gazetteer)) == [
        (1, "Falcon", "vehicle", 2), (1, "NASA", "company", 1), (5, "NASA", "company", 1), (5, "Texas", "place", 2), (5, "texas", "ship", 2),
    ]


def _rules(spark):
    return spark.createDataFrame([("launch", "launches", 2), ("launch", "rocket", 1), ("engines", "engines", 1), ("people", "crew", 2), ("aaa", "crew", 2)], "topic string, term string, weight long")


def test_topics(spark):
    assert rows(content.topics(_docs(spark), ["id"], "text", _rules(spark))) == [
        (1, "launch", 5), (2, "engines", 4), (3, "other", 0), (4, "other", 0), (5, "aaa", 4), (6, "other", 0),
    ]


def test_enriched_row_per_document(spark):
    gazetteer = spark.createDataFrame([("NASA", "company")], "entity string, kind string")
    docs = _docs(spark).withColumn("lang", F.lit("en"))
    got = {r["id"]: r for r in content.enrich(docs, ["id"], "text", gazetteer, _rules(spark), carry=["lang"], k=2).collect()}
    assert set(got) == set(TEXTS)
    assert [k["term"] for k in got[1]["keywords"]] == [w for d, _, w, _ in brute_keywords(TEXTS, 2) if d == 1]
    assert [tuple(e) for e in got[5]["entities"]] == [("NASA", "company", 1)]
    assert (got[3]["topic"], got[3]["keywords"], got[3]["entities"], got[3]["lang"]) == ("other", None, None, "en")


def test_words_are_counted_before_they_are_shuffled_and_only_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    df = content.keywords(docs, ["doc_id"], "text")
    df._jdf.queryExecution().toRdd().count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_words_of_any_script(spark):
    texts = {1: "Zürich und Élodie; Übergröße", 2: "España: corazón NIÑO", 3: "Союз стартовал с Байконура", 4: "ESA, ISS and the x 42"}
    got = rows(content.term_counts(_docs(spark, texts), ["id"], "text", 1), "id", "term")
    want = [
        (1, "zürich"), (1, "und"), (1, "élodie"), (1, "übergröße"), (2, "españa"), (2, "corazón"), (2, "niño"),
        (3, "союз"), (3, "стартовал"), (3, "с"), (3, "байконура"), (4, "esa"), (4, "iss"), (4, "and"), (4, "the"), (4, "x"),
    ]
    assert got == sorted(want, key=repr)
    kept = {r[2] for r in rows(content.keywords(_docs(spark, texts), ["id"], "text", k=9), "id", "rank", "term")}
    assert {"esa", "iss", "союз"} <= kept and not {"the", "x", "с"} & kept


def test_names_of_several_words(spark):
    names = [("Blue Origin", "company"), ("New York", "place"), ("New York Times", "company"), ("NASA", "company"), ("Ariane 5 ESC", "vehicle"), ("!!", "none")]
    texts = {1: "Blue Origin and blue\norigin; New York, the New York Times", 2: "origin blue NASA new", 3: None, 4: "ariane esc"}
    gazetteer = spark.createDataFrame(names + names[:1], "entity string, kind string")
    assert rows(content.entities(_docs(spark, texts), ["id"], "text", gazetteer)) == [
        (1, "Blue Origin", "company", 2), (1, "New York Times", "company", 1), (1, "New York", "place", 2),
        (2, "NASA", "company", 1), (4, "Ariane 5 ESC", "vehicle", 1),
    ]


def test_rule_terms_are_folded(spark):
    rules = spark.createDataFrame([("space", "NASA", 2), ("space", "nasa", 1), ("other", "crew", 2)], "topic string, term string, weight long")
    assert rows(content.topics(_docs(spark, {1: "NASA and crew"}), ["id"], "text", rules)) == [(1, "space", 3)]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_names_that_begin_alike_are_walked_word_by_word(spark, monkeypatch, limit):
    monkeypatch.setattr(content, "_FIRST_WORDS", limit)
    names = ["deep space", "deep space network", "Deep Space Network one", "deep sea", "one", "space network", "l'air du temps", "deep"]
    gazetteer = spark.createDataFrame([(n, "k") for n in names] + [("deep space", "other")], "entity string, kind string")
    docs = spark.createDataFrame(
        [(1, "Deep space network one, deep-space."), (2, "deep"), (3, "L'air du temps; deep deep space"), (4, None), (5, "network one")],
        "doc_id long, text string",
    )
    found = content.entities(docs, ["doc_id"], "text", gazetteer)
    assert rows(found) == sorted([
        (1, "Deep Space Network one", "k", 1), (1, "deep", "k", 2), (1, "deep space", "k", 2), (1, "deep space", "other", 2),
        (1, "deep space network", "k", 1), (1, "one", "k", 1), (1, "space network", "k", 1), (2, "deep", "k", 1), (3, "deep", "k", 2),
        (3, "deep space", "k", 1), (3, "deep space", "other", 1), (3, "l'air du temps", "k", 1), (5, "one", "k", 1),
    ], key=repr)


def test_the_prefix_table_has_a_row_for_each_node_and_name(spark):
    names = spark.createDataFrame([("A b", "x", ["a", "b"]), ("A b c", "x", ["a", "b", "c"])], "entity string, kind string, words array<string>")
    assert rows(content.prefix_table(names)) == sorted([
        ("a", 1, None, None, True), ("a b", 2, "A b", "x", True), ("a b c", 3, "A b c", "x", False),
    ], key=repr)

from collections import Counter

import __spark_entry__ as entry_point
import corpus_pipeline
import pytest

from test_duplicates import edited, groups_by_hand, prose, shingle_set, split
from test_text_and_rules import base_by_hand
from test_tokens import crc

NAMES = ["quality", "near_duplicates", "repeated_passages", "decontaminate", "pack"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with planted cases, as the tables the pipeline reads."""
    import random

    rng = random.Random(8)
    passage, item = prose(rng, 70, 3000), prose(rng, 30, 3000)
    texts = {i: prose(rng, rng.randint(90, 200), 3000) for i in range(60)}
    labels = [(i, 1) for i in texts]
    for i in range(60, 90):  # junk
        texts[i] = " ".join(w + "##" for w in prose(rng, 100, 3000).split())
        labels.append((i, 0))
    texts[100], texts[101] = texts[0], edited(rng, texts[1], 2)  # copies
    texts[110] = f"{prose(rng, 40, 3000)} {passage} {prose(rng, 60, 3000)}"
    texts[111] = f"{prose(rng, 90, 3000)} {passage} {prose(rng, 30, 3000)}"
    texts[120] = f"{prose(rng, 60, 3000)} {item} {prose(rng, 60, 3000)}"
    texts[130] = None
    path = f"file://{tmp_path_factory.mktemp('corpus')}"
    docs = [(i, t, "en", "s", len(t or ""), f"own {i}") for i, t in texts.items()] + [(5, texts[5], "en", "s", 1, "own 5")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key_ string"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(rng, 25, 3000))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, texts, passage, item


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


def test_every_stage_takes_effect(spark, folder, word_ids, tmp_path):
    path, texts, passage, item = folder
    docs, left = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        left[name] = docs.collect()
        assert name == "pack" or docs.columns == columns

    clean = {i for i, t in texts.items() if not base_by_hand(t)[5] and not 60 <= i < 90}
    assert Counter(r.doc_id for r in left["quality"]) == Counter([*clean, 5])
    hand = groups_by_hand([(r.doc_id, r.text) for r in left["quality"]], 5)
    assert sorted(r.doc_id for r in left["near_duplicates"]) == sorted({h[2] for h in hand})
    assert {0, 1} <= {r.doc_id for r in left["near_duplicates"]} and not {100, 101} & {r.doc_id for r in left["near_duplicates"]}
    before, after = ({r.doc_id: r for r in left[n]} for n in ("near_duplicates", "repeated_passages"))
    assert set(before) == set(after)
    for i in before:
        gone = passage in before[i].text
        assert split(after[i].text) == split(before[i].text.replace(passage, " ")) and gone == (i in (110, 111))
        assert after[i].n_chars == (len(after[i].text) if gone else before[i].n_chars) and after[i].key_ == f"own {i}"
    need = shingle_set(item, 5)
    kept = {i for i in after if 100 * len(need & shingle_set(after[i].text, 5)) < 80 * len(need)}
    assert {r.doc_id for r in left["decontaminate"]} == kept == set(after) - {120}
    packed = {(r.doc_id, r.length, r.ids_crc32) for r in left["pack"]}
    assert packed == {(i, len(ids), crc(ids)) for i in kept for ids in [[*word_ids(after[i].text), 1]]}


def test_pipeline_of_nothing(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).collect() == []


def test_queries_are_registered():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))

from collections import Counter

import pytest
from helpers import rows

from galley.plans import content, word_stats
from galley.session import materialize

KEY = ("content_type", "id")


def batch(spark, *items):
    return spark.createDataFrame([("article", i, t) for i, t in items], "content_type string, id long, text string")


def learn(docs, place):
    word_stats.learn(materialize(content.term_counts(docs, KEY, "text", 1), "terms"), docs, KEY, place)


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def wanted(texts):
    counts = Counter(w for t in texts for w in set(t.lower().split()))
    return sorted([(w, n) for w, n in counts.items()] + [("", len(texts))], key=repr)


def known(spark, place):
    return rows(word_stats.stats(spark, place).filter("df > 0"))


def test_batches_add_up_and_new_versions_replace_old_ones(spark, place):
    learn(batch(spark, (1, "alpha beta beta"), (2, "beta")), place)
    assert known(spark, place) == wanted(["alpha beta", "beta"])
    learn(batch(spark, (3, "gamma"), (1, "gamma beta")), place)
    assert known(spark, place) == wanted(["gamma beta", "beta", "gamma"])
    learn(batch(spark, (2, None)), place)
    assert known(spark, place) == wanted(["gamma beta", "", "gamma"])
    learn(batch(spark, (2, None), (3, "gamma")), place)
    assert known(spark, place) == wanted(["gamma beta", "", "gamma"])


@pytest.mark.parametrize("last_step", ["word_delta", "word_stats", "item_terms"])
def test_a_batch_left_behind_is_applied_once(spark, place, monkeypatch, last_step):
    """The driver dies right after each step of a batch; the next batch finds the rest."""
    learn(batch(spark, (1, "alpha"), (2, "beta")), place)
    step = {"word_delta": "replace_table", "word_stats": "upsert", "item_terms": "upsert"}[last_step]
    real = getattr(word_stats, step)

    def dying(df, table, *args, **kwargs):
        out = real(df, table, *args, **kwargs)
        if table == place(last_step):
            raise RuntimeError("driver lost")
        return out

    monkeypatch.setattr(word_stats, step, dying)
    with pytest.raises(RuntimeError):
        learn(batch(spark, (2, "beta gamma"), (3, "beta")), place)
    monkeypatch.setattr(word_stats, step, real)
    learn(batch(spark, (4, "delta")), place)
    assert known(spark, place) == wanted(["alpha", "beta gamma", "beta", "delta"])


def test_scores_of_a_day_are_those_of_everything(spark, place):
    docs = batch(spark, (1, "alpha beta beta"), (2, "beta gamma"), (3, "alpha delta"))
    for i in (1, 2, 3):
        learn(docs.filter(f"id = {i}"), place)
    whole = rows(content.keywords(docs, KEY, "text"))
    parts = [content.keywords(docs.filter(f"id = {i}"), KEY, "text", stats=word_stats.stats(spark, place)) for i in (1, 2, 3)]
    assert sorted((r for p in parts for r in rows(p)), key=repr) == whole

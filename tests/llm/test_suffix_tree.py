import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from galley.llm import suffix_tree

END = " "


def symbols(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", folded) if w] + [END]


def brute(docs, folds=7, held_out=2, depth=3, p_min=2e-6, least_count=4, least_gain=0.01):
    """The tree as dictionaries, by the same definitions."""
    texts = [(i, zlib.crc32(str("" if i is None else i).encode()) % folds == held_out, symbols(t)) for i, t in docs]
    word, pair = Counter(), defaultdict(Counter)
    for _, held, own in texts:
        if held:
            continue
        word.update(own)
        line = [END, *own]
        for at in range(1, len(line)):
            for n in range(1, min(depth, at) + 1):
                pair[tuple(line[at - n : at])][line[at]] += 1
    tokens, kinds = sum(word.values()), len(word)
    least = max(least_count, math.ceil(p_min * tokens))

    def often(context):
        """Every word of it, and every run in it, is frequent; the start is as frequent as there are texts."""
        if len(context) == 1:
            return word[context[0]] >= least
        return pair[context[:-1]][context[-1]] >= least

    kept = {}

    def probability(symbol, context):
        p = (word[symbol] + 1) / (tokens + kinds + 1)
        for n in range(1, len(context) + 1):
            state = context[-n:]
            if state in kept:
                total, share = kept[state]
                p = (pair[state][symbol] + share * p) / (total + share)
        return p

    for n in range(1, depth + 1):
        passed = {}
        for context, after in pair.items():
            if len(context) == n and often(context):
                total, share, gain = sum(after.values()), len(after), 0.0
                for symbol, count in after.items():
                    p = probability(symbol, context[1:])
                    p = p if n == 1 else float(np.float32(p))
                    gain += count * math.log((count - 1 + share * p) / (total - 1 + share) / p)
                if gain >= least_gain * total:
                    passed[context] = (total, share)
        kept.update(passed)
    out = []
    for doc_id, held, own in texts:
        line, score, base = [END, *own], 0.0, 0.0
        for at in range(1, len(line)):
            score += math.log10(probability(line[at], tuple(line[max(0, at - depth) : at])))
            base += math.log10((word[line[at]] + 1) / (tokens + kinds + 1))
        out.append((doc_id, held, len(own), sum(word[s] > 0 for s in own), tokens, round(base, 6), round(score, 6)))
    return sorted(out, key=repr), kept, probability


def rows_of(df):
    rounded = [(*tuple(r)[:5], round(r["base_score"], 6), round(r["score"], 6)) for r in df.collect()]
    return sorted(rounded, key=repr)


def prose(seed, n):
    """Texts of a chain of words with a memory of two."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["a", "b"]
        for _ in range(rng.randrange(60)):
            follow = random.Random(f"{words[-2]} {words[-1]}")
            options = [f"{follow.choice('abcdefgh')}{follow.randrange(3)}" for _ in range(3)]
            words.append(rng.choice(options) if rng.random() < 0.9 else rng.choice("xyz"))
        out.append((i, " ".join(words)))
    return out


@pytest.mark.parametrize("settings", [{}, {"depth": 1}, {"p_min": 0.004, "least_gain": 0.1}, {"block_tokens": 7, "bucket_pairs": 50}, {"depth": 4, "folds": 2, "held_out": 1}])
def test_equals_brute_force(spark, settings):
    docs = prose(3, 120) + [(None, "a b A\tB  a\n"), (None, None), (7, "a b"), (7, "a b"), (500, ""), (501, "é ß 漢 \x1c ü")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want, kept, _ = brute(docs, **{k: v for k, v in settings.items() if k not in ("block_tokens", "bucket_pairs")})
    assert rows_of(suffix_tree.score(frame, **settings)) == want
    assert kept and max(map(len, kept)) == min(settings.get("depth", 3), max(map(len, kept)))


def test_awkward_rows(spark, texts_frame):
    docs = [tuple(r) for r in texts_frame.select("doc_id", "text").collect()]
    assert rows_of(suffix_tree.score(texts_frame)) == brute(docs)[0]


def test_long_texts_are_split_into_words_in_stretches(monkeypatch):
    data = b"Some words  and\tmore " * 40 + b"x" * 100 + b" end"
    monkeypatch.setattr(suffix_tree, "_STRETCH", 13)
    runs = list(suffix_tree._words(data))
    assert len(runs) > 5 and [w for r in runs for w in r] == data.lower().split()


def test_held_out_texts_are_better_under_the_tree(spark):
    frame = spark.createDataFrame(prose(8, 900), "doc_id long, text string")
    held = suffix_tree.score(frame).filter("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert (held["sum(score)"] - held["sum(base_score)"]) / held["sum(n_tokens)"] > 0.3


def test_probabilities_add_up_to_one():
    """After any context: all known symbols, and one class for the rest."""
    docs = prose(5, 100)
    _, kept, probability = brute(docs)
    known = {s for i, t in docs if zlib.crc32(str(i).encode()) % 7 != 2 for s in symbols(t)}
    for context in [(), *list(kept)[:40]]:
        assert abs(sum(probability(s, context) for s in [*known, "never-seen"]) - 1) < 1e-9


def test_no_training_texts_and_empty_table(spark, no_texts):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = suffix_tree.score(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows} == {(3, 0, 0, 0.0, 0.0)}
    assert suffix_tree.score(no_texts).count() == 0

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from galley.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def buckets_of(text, max_n, buckets):
    words = words_of(text)
    runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(docs, target, percent, least, max_n, buckets, seed=2024):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text, max_n, buckets))
    for text in target:
        t.update(buckets_of(text, max_n, buckets))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (total_s + buckets) / ((s[b] + 1.0) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        found = buckets_of(text, max_n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(words_of(text)), len(found), weight, score, None])
    able = [r for r in out if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return sorted(map(tuple, out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("max_n,buckets", [(1, 10_000), (3, 97), (2, 70_000)])
def test_equals_brute_force(spark, texts_frame, awkward, max_n, buckets):
    docs = [tuple(r) for r in texts_frame.select("doc_id", "text").collect()]
    target = ["Two words and more", None, "word word é 漢字 123", "x" * 3000]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(texts_frame, wanted, percent=60, least_words=2, max_n=max_n, buckets=buckets)
    assert rows_of(got) == brute(docs, target, 60, 2, max_n, buckets)


def test_ranks_of_ties_and_copies_have_no_gap(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 30 + [(4, "a b c")] * 30 + [(5, None)] * 3, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("a",)], "text string")
    ranks = [r["rank"] for r in importance.resample(docs, target, 50, 1).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 31)) and len(ranks) == 63


def test_long_texts_are_scanned_in_stretches(monkeypatch):
    text = ("Alpha beta-gamma " * 50 + "z" * 500 + " é漢 tail") * 7
    texts = [text.encode(), b"", b"one", b"-", ("y" * 400).encode()]
    whole = importance.features(texts, 3, 1009)
    monkeypatch.setattr(importance, "_STRETCH", 97)
    parts = importance.features(texts, 3, 1009)
    want = [buckets_of(t.decode(), 3, 1009) for t in texts]
    for words, found in (whole, parts):
        assert words.tolist() == [len(words_of(t.decode())) for t in texts]
        assert [f.tolist() for f in found] == want


def test_a_full_dictionary_begins_anew():
    dictionary = importance.Dictionary(most=10)
    for i in range(20):
        words = [f"w{j}" for j in range(i, i + 7)]
        end, crc, length = dictionary.scan(" ".join(words).encode())
        assert crc.tolist() == [zlib.crc32(w.encode()) for w in words] and length.tolist() == [len(w) for w in words]
        assert len(dictionary.known) <= 10 and len(end) == 7


def test_crc_of_a_run_follows_from_its_parts(rng):
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(20)), rng.randbytes(rng.randrange(300))
        crc = [np.array([zlib.crc32(x)], np.uint32) for x in (a, b)]
        assert importance.joined(crc[0], crc[1], np.array([len(b)])).tolist() == [zlib.crc32(a + b)]


def test_empty_tables(spark, no_texts, texts_frame):
    assert importance.resample(no_texts, texts_frame).count() == 0
    none = importance.resample(texts_frame, no_texts.select("text"))
    assert none.count() == texts_frame.count()

import re
from collections import Counter

import numpy as np
import pytest

from galley.llm import containment, suffix_dedup, super_minhash
from galley.llm.components import components
from galley.llm.common import Stage
from galley.llm.rolling import Rolling, sliding_argmin, word_hashes

DOCS = "doc_id long, text string"


def key(row):
    return tuple((v is not None, v) for v in row)


def split(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())


def shingle_set(text, k):
    w = [x.lower() for x in split(text)]
    return frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))) if w else frozenset()


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


# Hashes


def test_rolling_hash_depends_on_content_alone():
    data = np.frombuffer(b"abcabcabd", dtype=np.uint8)
    r = Rolling(data)
    h = r.all_of(3)
    assert h[0] == h[3] and h[1] == h[4] and h[0] != h[6] and len(set(h.tolist())) == 4
    assert r.of(np.array([0]), np.array([3]))[0] == r.of(np.array([3]), np.array([6]))[0]
    assert len(r.all_of(10)) == 0


def test_words_are_cut_at_ascii_white_space():
    hashes, starts, ends = word_hashes("a\tbc\x0bé a\x1ca".encode())
    assert [(a, b) for a, b in zip(starts, ends)] == [(0, 1), (2, 4), (5, 7), (8, 11)]
    assert len(set(hashes.tolist())) == 4


def test_sliding_argmin_takes_the_leftmost():
    values = np.array([5, 1, 7, 1, 9, 9, 0], dtype=np.uint64) << np.uint64(40)
    for width in range(1, 8):
        want = [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]
        assert sliding_argmin(values, width).tolist() == want


# Components


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Stage(spark, "t"), "x").collect()}
    want = {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in (200, 201, 202)}}
    assert got == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Stage(spark, "t"), "x").collect() == []


# SuperMinHash


def test_signatures_estimate_similarity(rng):
    errors = []
    for shared in (20, 50, 80, 95):
        pool = [int(x) for x in np.random.default_rng(shared).integers(1, 1 << 62, 200 - shared)]
        a = np.unique(np.array(pool[:100], dtype=np.uint64))
        b = np.unique(np.array(pool[100 - shared : 200 - shared], dtype=np.uint64))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs(np.mean(super_minhash.signature(a) == super_minhash.signature(b)) - true))
    assert max(errors) < 0.12


def test_signature_of_a_union_is_the_smaller_of_both():
    x = np.random.default_rng(2).integers(1, 1 << 62, 900).astype(np.uint64)
    whole = super_minhash.signature(x)
    assert np.array_equal(whole, np.minimum(super_minhash.signature(x[:300]), super_minhash.signature(x[300:])))


def groups_by_hand(docs, k):
    sets = [shingle_set(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(root(i)), d == least.get(root(i))) for i, (d, _) in enumerate(docs)]


def near_documents(rng):
    texts = [prose(rng, 80) for _ in range(15)]
    base = prose(rng, 60)
    texts += [edited(rng, base, rng.choice([1, 2, 3, 4])) for _ in range(40)]  # a group with links near the threshold
    chain = prose(rng, 100)
    for _ in range(12):  # a chain whose ends are far apart
        chain = edited(rng, chain, 3)
        texts.append(chain)
    texts += ["", None, "   ", "one", "One", "one two", "ONE two", "x y z", "x  y\tz", base.upper(), prose(rng, 6000)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "only here, without id"), (3, texts[3]), (3, "other text of three")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, rng, k):
    docs = near_documents(rng)
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], DOCS + ", name string")
    got = super_minhash.near_duplicates(frame, k).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=key) == sorted(groups_by_hand(docs, k), key=key)


def test_large_bucket_is_searched_in_blocks(spark, rng, monkeypatch):
    monkeypatch.setattr(super_minhash, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(super_minhash, "BLOCK_TEXT", 2000)
    base = prose(rng, 60)
    docs = [(i, edited(rng, base, rng.choice([2, 3, 4, 5]))) for i in range(60)]
    got = super_minhash.near_duplicates(spark.createDataFrame(docs, DOCS), 2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(groups_by_hand(docs, 2))


def test_one_row_of_each_group_stays(spark, rng):
    docs = near_documents(rng)
    frame = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(docs)], DOCS + ", copies int")
    got = super_minhash.one_of_each(frame, 5).collect()
    hand = groups_by_hand(docs, 5)
    empty = sum(1 for h in hand if h[1] == 0)
    named = {h[2] for h in hand if h[1] and h[2] is not None}
    without = 1  # the group that has no id at all
    # the id 3 has two texts: its group and the other one are both named 3
    assert len(got) == empty + len(named) + without + 1
    assert frame.columns == list(got[0].asDict())


def test_near_duplicates_of_nothing(spark, no_texts):
    assert super_minhash.near_duplicates(no_texts, 2).collect() == []
    assert super_minhash.one_of_each(no_texts, 2).collect() == []


# Repeated substrings


def spans_by_hand(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        edges = [i for i in range(len(t) + 1) if (hit[i] if i < len(t) else 0) != (hit[i - 1] if i else 0)]
        out.append(list(zip(edges[::2], edges[1::2])))
    return out


def test_repeated_bytes_equal_brute_force(spark, rng):
    parts = ["".join(rng.choices("ab", k=90)) for _ in range(3)] + ["é" * 40, "".join(rng.choices("abcdefgh", k=150))]
    texts = [None, "", "a" * 300, "a" * 99, "a" * 100, "ab" * 80, parts[0] * 3, parts[4] + "x", "y" + parts[4]]
    texts += ["".join(rng.choices(parts, k=4)) for _ in range(12)] + [parts[3] * 2 + "z"] * 2
    docs = [(i if i % 5 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(d, t, [1]) for d, t in docs], DOCS + ", runs array<int>")
    got = suffix_dedup.without_repeats(frame, 100).collect()
    raw = [(t or "").encode() for t in texts]
    want = []
    for (d, _), t, spans in zip(docs, raw, spans_by_hand(raw, 100)):
        kept = b"".join(t[a:b] for a, b in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(t)]))
        want.append((d, len(t), tuple(spans), kept))
    assert sorted(((r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got), key=key) == sorted(want, key=key)


def test_repeated_words_equal_brute_force(spark, rng):
    passage = [prose(rng, 60) for _ in range(3)]
    texts = [prose(rng, 120) for _ in range(6)]
    texts += [f"{prose(rng, 30)}\n{passage[i % 3]}\n{prose(rng, 20)}" for i in range(9)]
    texts += [None, "short", passage[0], passage[1].replace(" ", "\n ")]
    frame = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], DOCS + ", n_chars long")
    got = {r.doc_id: r for r in suffix_dedup.cleaned(frame, 50).collect()}
    assert len(got) == len(texts)
    seen = Counter(tuple(w[i : i + 50]) for t in texts for w in [split(t)] for i in range(len(w) - 49))
    for i, t in enumerate(texts):
        words = split(t)
        hit = [False] * len(words)
        for j in range(len(words) - 49):
            if seen[tuple(words[j : j + 50])] > 1:
                hit[j : j + 50] = [True] * 50
        assert split(got[i].text) == [w for w, h in zip(words, hit) if not h]
        assert got[i].n_chars == (len(got[i].text) if any(hit) else 5)
    assert got[15].text is None


def test_repeats_of_nothing(no_texts):
    assert suffix_dedup.without_repeats(no_texts, 100).collect() == []
    assert suffix_dedup.cleaned(no_texts, 50).collect() == []


# Containment


def test_contained_items_equal_brute_force(spark, rng):
    items = [(i, prose(rng, n, 5000)) for i, n in enumerate([5, 6, 9, 15, 16, 30, 31, 40, 64, 90, 3, 1])]
    items += [(20, None), (21, ""), (None, prose(rng, 20, 5000)), (22, items[5][1])]
    docs = [(i, prose(rng, 200, 5000)) for i in range(4)]
    for i, t in [x for x in items if x[1]]:
        for loss in (0, 1, 2, 4, 8):
            words = t.split()
            for _ in range(min(loss, len(words))):
                words[rng.randrange(len(words))] = "changed"
            docs.append((len(docs), f"{prose(rng, 40, 5000)} {' '.join(words).upper()} {prose(rng, 300, 5000)}"))
    docs += [(None, items[4][1]), (5, None), (6, ""), (7, "w1"), (8, items[10][1]), (9, items[11][1]), (1, items[6][1]), (1, items[6][1])]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS + ", item_id int")
    got = containment.matches(frame, spark.createDataFrame([(i, t, "h") for i, t in items], "item_id long, text string, hash string"))
    want = []
    for d, t in docs:
        have = shingle_set(t, 5)
        for i, u in items:
            need = shingle_set(u, 5)
            if need and 100 * len(need & have) >= 80 * len(need):
                want.append((d, i, len(need), len(need & have)))
    found = got.select("doc_id", "item_id", "n_shingles", "n_shared").collect()
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    clean = containment.clean(frame, spark.createDataFrame(items, "item_id long, text string"))
    leaked = {(d, t) for d, t in docs for i, u in items if (n := shingle_set(u, 5)) and 100 * len(n & shingle_set(t, 5)) >= 80 * len(n)}
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=key) == sorted([x for x in docs if x not in leaked], key=key)
    assert clean.columns == frame.columns


def test_containment_of_nothing(spark, no_texts):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    assert containment.matches(no_texts, items).collect() == []
    assert containment.matches(docs, none).collect() == []
    assert containment.clean(docs, none).count() == 1


def test_containment_runs_no_python(spark, plan):
    docs = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert not re.search("Python|Pandas|Arrow", plan(containment.matches(docs, items)).replace("Scan ExistingRDD", ""))


def test_variants_of_one_text_cost_rows_in_proportion(spark, monkeypatch):
    """All variants meet in the same buckets: as many pairs as variants, and nothing is left for blocks."""
    counted = {}

    def counting(name, real):
        def run(df, *args):
            counted[name] = counted.get(name, 0) + df.count()
            return real(df, *args)

        return run

    for name in ("_near_centers", "_grid"):
        monkeypatch.setattr(super_minhash, name, counting(name, getattr(super_minhash, name)))
    words = " ".join(f"w{i}" for i in range(40))
    seen = {}
    for n in (4_000, 16_000):
        counted.clear()
        docs = spark.range(n, numPartitions=8).selectExpr("id AS doc_id", f"concat('{words} tail', id) AS text")
        found = super_minhash.near_duplicates(docs, k=2)
        assert found.filter("kept").count() == 1 and found.filter("component_id = 0").count() == n
        seen[n] = dict(counted)
    assert seen[16_000]["_near_centers"] <= 4.4 * seen[4_000]["_near_centers"] <= 4.4 * 45 * 4_000
    assert seen[16_000]["_grid"] <= 4.4 * max(seen[4_000]["_grid"], 500)


def test_the_rest_of_a_bucket_is_held_against_all_of_it(spark, rng, monkeypatch):
    """Chains of near texts whose ends are no links of each other, in one large bucket of short bands."""
    monkeypatch.setattr(super_minhash, "BLOCK_MEMBERS", 5)
    monkeypatch.setattr(super_minhash, "BLOCK_TEXT", 900)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for chain in range(6):
        words = list(base)
        for i in range(chain * 4):
            words[i] = f"c{chain}x{i}"
        for step in range(12):
            words[20 + 2 * step] = f"c{chain}s{step}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in super_minhash.near_duplicates(docs, k=1).collect()}
    sets = [set(t.split()) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert got == {i: root(i) for i in range(len(texts))}

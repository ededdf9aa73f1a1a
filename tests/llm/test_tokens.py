import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from galley.llm import packing, token_store
from galley.llm.bpe_count import MergeCounter, token_counts
from galley.llm.word_ids import WordEncoder


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def key(row):
    return tuple((v is not None, v) for v in row)


# Token counts


def test_counts_equal_the_library(spark, texts_frame, byte_file):
    library = Tokenizer.from_file(byte_file)
    got = sorted(map(tuple, token_counts(texts_frame, byte_file).collect()), key=key)
    want = [(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in texts_frame.collect()]
    assert got == sorted(want, key=key)


def test_counts_of_nothing(no_texts, byte_file):
    assert token_counts(no_texts, byte_file).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tabcdeé漢1'.,s😀 |<>", max_size=40))
def test_counts_of_any_text(text):
    counter, library = _tools()
    assert counter.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


def _tools(kept=[]):  # noqa: B006
    if not kept:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
        kept += [MergeCounter(path), Tokenizer.from_file(path)]
    return kept


def test_merges_follow_the_lowest_rank():
    counter, library = _tools()
    for word in ("aaaaaaa", "abababab", "internationalization", "zzzzyyyyzzzz", "ÿÿÿÿ"):
        assert counter.piece(word.encode()) == len(library.encode(word).ids)


# Word ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tabZzeéÉß漢1'.,s*😀 ́İΣ", max_size=40))
def test_word_ids_of_any_text(text):
    import public_tokenizers

    encoder, library = _word_tools(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.ids(encoder.encode(text.encode())).tolist() == library.encode(text, add_special_tokens=False).ids


def _word_tools(path, kept=[]):  # noqa: B006
    if not kept:
        kept += [WordEncoder(path), Tokenizer.from_file(path)]
    return kept


# Elias-Fano


@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_gives_back_rising_numbers(steps):
    values = np.cumsum(np.array(steps, dtype=np.int64))
    code = token_store.EliasFano.build(values)
    assert code.values().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(200, 1800, 10_000))
    code = token_store.EliasFano.build(values)
    assert 8 * (code.low.nbytes + code.high.nbytes) < 12.5 * len(values)


# Token store


def test_store_gives_back_every_document(spark, texts_frame, word_file, word_ids, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write(texts_frame, path, word_file, end_id=1)
    docs = sorted(texts_frame.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.text or ""))
    want, start = [], 0
    for r in docs:
        ids = [*word_ids(r.text), 1]
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = token_store.read(spark, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    tokens = defaultdict(list)
    for r in token_store.tokens(spark, path).collect():
        tokens[r.doc_id].append(r.ids)
    for r in docs:
        assert [*word_ids(r.text), 1] in tokens[r.doc_id]


def test_store_in_small_blocks(spark, texts_frame, word_file, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/store"
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 64)
    token_store.write(texts_frame, path, word_file, end_id=1)
    got = sorted((r.start, r.n_tokens) for r in token_store.read(spark, path).collect())
    assert len(got) == texts_frame.count()
    assert all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))


def test_store_of_nothing(spark, no_texts, word_file, tmp_path):
    token_store.write(no_texts, f"file://{tmp_path}/store", word_file, end_id=1)
    assert token_store.read(spark, f"file://{tmp_path}/store").collect() == []


# Packing


def unpacked(placements):
    """Offsets and lengths by sequence, and the ranks used of each length."""
    held, ranks = defaultdict(list), defaultdict(list)
    for length, first, pieces, sequence, each, at in placements:
        for r in range(pieces):
            held[sequence + r // each].append((at + (r % each) * length, length))
            ranks[length].append(first + r)
    return held, ranks


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([7, 20, 100]), st.dictionaries(st.integers(1, 100), st.integers(1, 9), max_size=40))
def test_plan_is_valid(capacity, counts):
    counts = {k: n for k, n in counts.items() if k <= capacity}
    placements, opened = packing.plan(counts, capacity)
    held, ranks = unpacked(placements)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(held) == list(range(opened))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def fewest(items, capacity):
    """The smallest number of sequences, by trying everything."""
    best = [len(items)]
    items = sorted(items, reverse=True)

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            put(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        put(i + 1, [*rooms, capacity - items[i]])

    put(0, [])
    return best[0]


def test_reduction_does_not_cost_a_sequence(rng):
    worse = 0
    for _ in range(150):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 8))]
        _, opened = packing.plan({x: items.count(x) for x in items}, 20)
        worse += opened - fewest(items, 20)
    assert worse <= 1


@pytest.mark.parametrize("items", [[10, 10], [12, 8, 5], [15, 3, 3, 17], [20, 20, 1], [11, 11, 11]])
def test_dominating_sets_are_fixed_at_the_least_number(items):
    _, opened = packing.plan({x: items.count(x) for x in items}, 20)
    assert opened == fewest(items, 20)


def test_pack_places_every_piece(spark, texts_frame, word_file, word_ids):
    capacity = 50
    got = packing.pack(texts_frame, word_file, 1, capacity).collect()
    want = []
    for r in texts_frame.collect():
        ids = [*word_ids(r.text), 1]
        want += [(r.doc_id, n, a, len(ids[a : a + capacity]), crc(ids[a : a + capacity])) for n, a in enumerate(range(0, len(ids), capacity))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(w[3] for w in want)
    assert len(held) <= -(-total // capacity) + 1


def test_packed_sequences_hold_the_ids(spark, word_file, word_ids):
    docs = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string")
    placed = packing.pack(docs, word_file, 1, 10, with_ids=True)
    (row,) = packing.sequences(placed).collect()
    ids = np.frombuffer(bytes(row.ids), dtype="<u4").tolist()
    parts = {r.doc_id: ids[r.offset : r.offset + r.length] for r in placed.collect()}
    assert parts == {1: [*word_ids("one two three"), 1], 2: [*word_ids("four"), 1]}


def test_pack_nothing(no_texts, word_file):
    assert packing.pack(no_texts, word_file, 1, 10).collect() == []

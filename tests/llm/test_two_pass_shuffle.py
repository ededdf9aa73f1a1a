import zlib
from collections import Counter, defaultdict

from galley.llm import two_pass_shuffle as shuffle

SCHEMA = "doc_id long, text string, slot long, shard int"


def shuffled(spark, docs, path, **how):
    shuffle.write_shuffled(docs, path, **how)
    return spark.read.schema(SCHEMA).parquet(path)


def test_every_row_has_one_slot(spark, texts_frame, tmp_path):
    got = shuffle.digest(shuffled(spark, texts_frame, f"file://{tmp_path}/s", shards=4)).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in texts_frame.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_more_shards_than_rows_and_many_buckets(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 50) for i in range(10)], "doc_id long, text string")
    got = shuffled(spark, docs, f"file://{tmp_path}/s", shards=24, bucket_bytes=100).collect()
    assert sorted(r.doc_id for r in got) == list(range(10))
    assert all(r.slot == 0 for r in got) and len({r.shard for r in got}) == 10


def test_same_seed_same_order_other_seed_other_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(200)], "doc_id long, text string")
    order = lambda name, d, seed: [
        r.doc_id for r in sorted(shuffled(spark, d, f"file://{tmp_path}/{name}", shards=1, seed=seed).collect(), key=lambda r: r.slot)
    ]
    first = order("a", docs, 1)
    assert order("b", docs.repartition(7), 1) == first
    assert order("c", docs, 2) != first and first != sorted(first)


def test_nothing(spark, no_texts, tmp_path):
    shuffle.write_shuffled(no_texts, f"file://{tmp_path}/s", shards=3)
    assert spark.read.schema(SCHEMA).parquet(f"file://{tmp_path}/s").collect() == []


def test_equal_rows_are_spread_over_buckets(spark, tmp_path, monkeypatch):
    """A third of all rows are one row, a tenth have no id and one text; no bucket holds many of them."""
    monkeypatch.setattr(shuffle, "COPIES", 50)
    docs = [(i, f"text {i}") for i in range(1700)] + [(7, "x" * 20)] * 1000 + [(None, None)] * 300
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    numbered = shuffle._numbered(frame).collect()
    assert Counter((r.doc_id, r.text) for r in numbered) == Counter(docs)
    assert sorted(r.copy for r in numbered if r.text == "x" * 20) == list(range(1, 1001))
    got = shuffled(spark, frame, f"file://{tmp_path}/s", shards=10, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(docs)
    held = Counter(r.shard for r in got if r.doc_id == 7 and r.text == "x" * 20)
    assert len(held) == 10 and max(held.values()) < 200


def test_each_bucket_is_a_task(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(400)], "doc_id long, text string")
    shuffle.write_shuffled(docs, f"file://{tmp_path}/s", shards=1, bucket_bytes=4000)
    assert len(list((tmp_path / "s" / "shard=0").glob("*.parquet"))) == -(-400 * 108 // 4000)

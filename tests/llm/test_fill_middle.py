import hashlib
import re

import pytest
from pyspark.sql import functions as F

from galley.llm import fill_middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text, seed=1, plain=10, spm=20):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
        return (doc_id, len(units), "plain", None, None, text)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_equals_brute_force_and_restores(spark, texts_frame):
    marked = spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate(["a<P>b", "<S", "<M>", "<", "x <S>", "<P", "P>", "a" * 9000, "é" * 5000, "\x00a\x00"])],
        "doc_id long, text string",
    )
    docs = texts_frame.select("doc_id", "text").union(marked).union(marked.withColumn("doc_id", F.col("doc_id") * -7))
    made = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored()).collect()
    want = [(*brute(*r), r["text"] or "") for r in docs.collect()]
    assert sorted(map(tuple, made), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("block", [1, 3, 64])
def test_every_border_is_found(block, rng):
    for text in ["", "a", "é", "ab c", "aé漢b  c1dE😀xy" * 9, "".join(rng.choice("ab é漢😀1") for _ in range(700))]:
        data = text.encode()
        borders = fill_middle.Borders(data, block)
        units = UNIT.findall(text)
        assert (borders.units, borders.points) == (len(units), len(text))
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert borders.find(k) == (len(before.encode()), len(before))


def test_slabs_of_blocks_add_up(monkeypatch):
    data = ("Some words, é and 漢字. " * 400).encode()
    whole = fill_middle.Borders(data, 16)
    monkeypatch.setattr(fill_middle, "_SLAB", 3)
    slabs = fill_middle.Borders(data, 16)
    assert slabs.tree.tolist() == whole.tree.tolist() and slabs.units == whole.units


def test_other_sentinels_and_shares(spark):
    scheme = fill_middle.Scheme("[pre]", "[s]", "[mid]", plain=0, spm=50)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), "id", F.lit(" é.")).alias("text"))
    made = fill_middle.fill_in_middle(docs, 9, scheme).withColumn("back", fill_middle.restored(scheme)).join(docs, "doc_id")
    assert made.filter("back <> text or form = 'plain'").count() == 0
    assert set(r[0] for r in made.select("form").distinct().collect()) == {"psm", "spm"}


def test_empty_table(no_texts):
    assert fill_middle.fill_in_middle(no_texts).count() == 0

"""Near-duplicate groups of documents by SuperMinHash, banding, exact checks and union-find.

1. Each text becomes its set of word shingles (64-bit hashes) and a SuperMinHash signature: for
   every shingle a random permutation of the slots, taken step by step; at step ``j`` the slot
   drawn gets ``j`` plus a uniform number if that is smaller. Steps end as soon as no slot can
   get smaller. Documents with the same set are one class from here on.
2. Bands of the signature put classes into buckets. Each class is paired with the smallest of each
   of its buckets, one row however large the bucket. Pairs whose signatures agree often enough (five
   standard deviations below the threshold pass) are checked on the full sets.
3. Confirmed links give components (large star, small star).
4. What a bucket's largest component does not hold, the rest of the bucket, is held against all of
   the bucket: first the signatures, then the full sets of those that agree; only links that join
   components leave a task.
5. Components are built again from all links.

In step 4 the rest of a bucket is dealt into blocks and so is all of the bucket; each pair of blocks is
one group of bounded size. A bucket that step 2 has linked throughout costs nothing there: a group of
a million variants of one text is a million rows in step 2 and none in step 4.

With 240 slots in 40 bands of 6, a pair at the threshold of 0.8 shares no band once in 200,000.
Work in step 4 grows with (rest of the bucket) x (classes of the bucket), spread over groups; no
bucket is cut off.

* null text, and text without a word, has an empty set and is linked with nothing
* fewer words than a shingle: the whole sequence is the one shingle
* a null doc_id takes part; it is never the smallest, unless all of its component are null
* repeated rows are in one class; each gets a row
* other columns are ignored; an empty table gives no rows
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from galley.llm.common import Stage, boxed, groups, id_and_text, map_batches, splittable, utf8
from galley.llm.components import components
from galley.llm.rolling import U, mix, word_hashes

BANDS, ROWS = 40, 6
SLOTS = BANDS * ROWS
_SEEN = 0xC2B2AE3D27D4EB4F
BLOCK_MEMBERS = 1024  # signatures of a block
BLOCK_TEXT = 4 << 20  # bytes of text of a block


def shingles(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct hashes of the ``k``-word shingles of a text; A-Z are lower-cased."""
    own, _, _ = word_hashes(text.lower())
    n = len(own)
    if not n:
        return own
    size = min(k, n)
    joined = np.full(n - size + 1, U(size))
    for i in range(size):
        joined = mix(joined * U(_SEEN) + own[i : n - size + 1 + i])
    return np.unique(joined)


def signature(items: np.ndarray) -> np.ndarray:
    """SuperMinHash of a set of hashes: ``SLOTS`` values, each step plus fraction."""
    best = np.full(SLOTS, np.inf)
    n = len(items)
    if not n:
        return best
    order = np.broadcast_to(np.arange(SLOTS, dtype=np.int16), (n, SLOTS)).copy() if n * SLOTS <= 1 << 22 else None
    if order is None:  # very long texts: in parts; the smallest value of each slot is kept
        for at in range(0, n, (1 << 22) // SLOTS):
            best = np.minimum(best, signature(items[at : at + (1 << 22) // SLOTS]))
        return best
    rows = np.arange(n)
    state = mix(items ^ U(0x5851F42D4C957F2D))
    for j in range(SLOTS):
        if best.max() <= j:  # no later step can lower a slot
            break
        state = mix(state + U(0x9E3779B97F4A7C15))
        drawn = j + ((state >> U(40)) % U(SLOTS - j)).astype(np.int64)
        slots = order[rows, drawn]
        order[rows, drawn] = order[:, j]
        order[:, j] = slots
        value = j + (state & U((1 << 40) - 1)).astype(np.float64) / (1 << 40)
        np.minimum.at(best, slots, value)
    return best


def _name(items: np.ndarray) -> bytes | None:
    """A 128-bit name of a set of hashes; none for the empty set."""
    if not len(items):
        return None
    return np.array([np.sum(mix(items)), np.bitwise_xor.reduce(mix(items * U(_SEEN) + U(1)))], dtype=">u8").tobytes()


def _describe(text: bytes, k: int) -> tuple[int, bytes | None, np.ndarray | None, bytes | None]:
    """Set size, a 128-bit name of the set, band keys and one byte per slot; none for an empty set."""
    items = shingles(text, k)
    if not len(items):
        return 0, None, None, None
    bits = mix(signature(items).view(U))
    keys = np.arange(1, BANDS + 1, dtype=U)
    for i in range(ROWS):
        keys = mix(keys * U(_SEEN) + bits.reshape(BANDS, ROWS)[:, i])
    return len(items), _name(items), keys.view(np.int64), (bits & U(255)).astype(np.uint8).tobytes()


def _describe_all(docs: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [_describe(t, k) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary()),
                 pa.array([g[2] for g in got], pa.list_(pa.int64())), pa.array([g[3] for g in got], pa.binary())],
                ["doc_id", "text_key", "n_shingles", "name", "bands", "slots"],
            )

    return map_batches(docs, run, "doc_id long, text_key long, n_shingles long, name binary, bands array<long>, slots binary")


def _least_agreement(percent: int) -> int:
    p = percent / 100
    return int(SLOTS * (p - 5 * (p * (1 - p) / SLOTS) ** 0.5))


_GRID = ("bucket", "rest_block", "block")


def _grid(members: DataFrame, size: Column, limit: int) -> DataFrame:
    """The rest of each bucket against all of it: groups ``_GRID`` with rows of both sides (``rest`` or not).

    ``members``: bucket, name, outside (whether it is of the bucket's rest) and columns that are
    carried. Either side is dealt into as many blocks as its total ``size`` has ``limit``.
    """
    total = members.groupBy("bucket").agg(F.sum(size).alias("all"), F.sum(F.when(F.col("outside"), size)).alias("rest"))
    blocks = [F.greatest(F.ceil(F.col(c) / limit), F.lit(1)).cast("int").alias(f"{c}_blocks") for c in ("all", "rest")]
    dealt = members.join(splittable(total.filter("rest is not null").select("bucket", *blocks)), "bucket")
    dealt = dealt.withColumns({
        "own": F.pmod(F.xxhash64("name"), "all_blocks").cast("int"), "own_rest": F.pmod(F.xxhash64("name"), "rest_blocks").cast("int")
    })
    carried = [c for c in members.columns if c not in ("bucket", "outside")]
    here = dealt.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("rest_block"), F.col("own").alias("block"),
        F.lit(False).alias("rest"), *carried,
    )
    rest = dealt.filter("outside").select(
        "bucket", F.col("own_rest").alias("rest_block"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("block"),
        F.lit(True).alias("rest"), *carried,
    )
    return here.unionAll(rest).repartition(*_GRID).sortWithinPartitions(*_GRID)


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the rest, and of the block that it is held against."""
    rest = group.column("rest").to_numpy()
    return np.flatnonzero(rest), np.flatnonzero(~rest)


def _slots(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SLOTS)


def _near_centers(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, slots_a, slots_b) whose signatures agree often enough."""
    least = _least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (_slots(batch.column(2)) == _slots(batch.column(3))).sum(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(agree))

    return map_batches(pairs.select("a", "b", "slots_a", "slots_b"), run, "a binary, b binary")


def _agreeing(members: DataFrame, percent: int) -> DataFrame:
    """``bucket, name`` of the members whose signatures agree across the rest of their bucket and another component."""
    least = _least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, _GRID):
            rest, here = _sides(group)
            slots = _slots(group.column("slots"))
            _, own = np.unique(np.array(group.column("component").to_pylist(), dtype=object), return_inverse=True)
            near = np.zeros(len(slots), dtype=bool)
            for i in rest:
                same = ((slots[here] == slots[i]).sum(axis=1) >= least) & (own[here] != own[i])
                if same.any():
                    near[here[same]] = near[i] = True
            if near.any():
                yield from group.select(["bucket", "name"]).filter(pa.array(near)).to_batches()

    dealt = _grid(members, F.lit(1), BLOCK_MEMBERS).select(*_GRID, "rest", "name", "component", "slots")
    return map_batches(dealt, run, "bucket long, name binary").distinct()


def _confirmed(pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b, text_a, text_b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(utf8(batch.column(2)), utf8(batch.column(3))):
                a, b = shingles(x, k), shingles(y, k)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(pairs.select("a", "b", "text_a", "text_b"), run, "a binary, b binary")


def _joining_links(group: pa.Table, k: int, percent: int) -> list[tuple[bytes, bytes]]:
    """Links between different components across a pair of blocks, as few as join all that can be joined."""
    names, own = group.column("name").to_pylist(), group.column("component").to_pylist()
    rest, here = _sides(group)
    if not len(rest) or not len(here) or len(set(own)) < 2:
        return []
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sets = [shingles(t, k) for t in utf8(group.column("text").combine_chunks())]
    sizes = np.array([len(sets[j]) for j in here])
    known, codes = np.unique(np.concatenate([sets[j] for j in here]), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    flag, out = np.zeros(len(known) + 1, dtype=np.int32), []
    for i in rest:
        at = np.searchsorted(known, sets[i])
        mine = at[known[np.minimum(at, len(known) - 1)] == sets[i]]
        flag[mine] = 1
        shared = np.add.reduceat(flag[codes], starts)
        flag[mine] = 0
        for j in here[100 * shared >= percent * (sizes + len(sets[i]) - shared)]:
            if (x := root(own[i])) != (y := root(own[j])):
                parent[x] = y
                out.append((names[i], names[j]))
    return out


def _searched_whole(members: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that join components, from the rest of each bucket against all of it (bucket, name, component, outside, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, _GRID):
            found = _joining_links(group, k, percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], ["a", "b"])

    dealt = _grid(members, F.octet_length("text"), BLOCK_TEXT).select(*_GRID, "rest", "name", "component", "text")
    return map_batches(dealt, run, "a binary, b binary").distinct()


def _labelled(members: DataFrame, grouped: DataFrame) -> DataFrame:
    """``bucket, name, component, outside`` of buckets whose members are not all of one component.

    ``outside``: the member is not of the largest component that the bucket holds.
    """
    named = members.join(grouped, members["name"] == grouped["node"], "left").select(
        "bucket", "name", F.coalesce("component", "name").alias("component")
    )
    sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    return named.join(splittable(main.select("bucket", F.col("main.component").alias("main"))), "bucket").select(
        "bucket", "name", "component", (F.col("component") != F.col("main")).alias("outside")
    )


def _class_texts(rows: DataFrame, classes: DataFrame, names: DataFrame) -> DataFrame:
    """``name, text``: the text of one row of each class in ``names``, found by the row's id and text hash."""
    one = classes.join(names, "name", "left_semi").select("name", F.col("one.doc_id").alias("id_"), F.col("one.text_key").alias("key_"))
    found = rows.join(splittable(one), rows["doc_id"].eqNullSafe(F.col("id_")) & (rows["text_key"] == F.col("key_")))
    return found.groupBy("name").agg(F.first("text").alias("text"))


def near_duplicates(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept, component`` per row of ``docs`` (doc_id, text).

    Documents are linked when 100 x common shingles >= ``percent`` x all shingles of both.
    ``kept``: the document is the one its group is named by. ``component`` names the group even
    where no id is known; it is null for an empty set.
    """
    stage = Stage(docs.sparkSession, "minhash")
    rows = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    described = stage.save(_describe_all(rows, k), "described")
    classes = stage.save(
        described.filter("name is not null").groupBy("name").agg(
            F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("slots").alias("slots"),
            F.min(F.struct("doc_id", "text_key")).alias("one"),
        ),
        "classes",
    )
    banded = classes.select("name", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("members"), F.min("name").alias("center")).filter("members > 1")
    held = stage.save(banded.join(splittable(buckets), "bucket").select("bucket", "name", "center"), "held")

    # Every class against the smallest of each of its buckets.
    signed = classes.select("name", "slots")
    pairs = held.filter("name != center").select(F.col("name").alias("a"), F.col("center").alias("b")).distinct()
    pairs = pairs.join(signed.toDF("a", "slots_a"), "a").join(signed.toDF("b", "slots_b"), "b")
    near = stage.save(_near_centers(pairs, percent), "near")
    texts = stage.save(_class_texts(rows, classes, near.select("a").union(near.select("b")).distinct().toDF("name")), "texts")
    checked = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    links = stage.save(_confirmed(checked, k, percent), "links")
    grouped = components(links, stage, "stars")
    stage.free("near", "texts")

    # What the largest component of a bucket does not hold, against all of the bucket.
    labelled = stage.save(_labelled(held.select("bucket", "name"), grouped), "labelled")
    agreeing = stage.save(_agreeing(labelled.join(signed, "name"), percent), "agreeing")
    undecided = labelled.join(agreeing, ["bucket", "name"])
    texts = stage.save(_class_texts(rows, classes, undecided.select("name").distinct()), "more-texts")
    more = stage.save(_searched_whole(undecided.join(texts, "name"), k, percent), "more")
    final = components(links.union(more), stage, "all")

    # The smallest doc_id of a component, over all of its classes.
    named = classes.select("name", "doc_id").join(final, F.col("name") == F.col("node"), "left").select(
        "name", "doc_id", F.coalesce("component", "name").alias("component")
    )
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    groups_of = stage.save(named.select("name", "component").join(ids, "component").select("name", "component", "component_id"), "groups")
    stage.free("classes", "held", "links", "stars-out", "labelled", "agreeing", "more-texts", "more", "all-out")

    out = described.select("doc_id", "text_key", "n_shingles", "name").join(groups_of, "name", "left")
    own = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "text_key", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "component"
    )



def one_of_each(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """One row of each group, with all columns of ``docs``: that of the smallest id.

    Documents with an empty set are linked with nothing and all stay. In a group without any id
    the text with the smallest hash stays. Of equal rows one stays.
    """
    stage = Stage(docs.sparkSession, "one-of-each")
    found = near_duplicates(docs, k, percent)
    copies = found.groupBy("component", "doc_id", "text_key").agg(F.count("*").alias("copies"), F.first("n_shingles").alias("size"))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key", "copies")).alias("x")
    chosen = copies.filter("size > 0").groupBy("component").agg(first).select("x.*", F.lit(False).alias("empty"))
    empty = copies.filter("size = 0").select(F.isnull("doc_id").alias("none"), "doc_id", "text_key", "copies", F.lit(True).alias("empty"))
    chosen = stage.save(
        chosen.union(empty).select(F.col("doc_id").alias("id__"), F.col("text_key").alias("key__"), "copies", "empty").distinct(), "chosen"
    )
    rows = boxed(docs)
    same = rows["doc_id"].eqNullSafe(chosen["id__"]) & (F.xxhash64("text") == chosen["key__"])
    once = rows.join(chosen.filter("copies = 1 or empty"), same, "left_semi").select("row.*")
    repeated = chosen.filter("copies > 1 and not empty")
    if repeated.isEmpty():
        return once
    return once.union(rows.join(repeated, same).dropDuplicates(["id__", "key__"]).select("row.*"))

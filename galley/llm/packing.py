"""Packing token pieces into sequences: Martello-Toth reduction, then best fit for the rest.

Only lengths matter for packing, and there are at most ``capacity`` of them. So the instance is
the table of how often each length occurs, whose size does not depend on the data. From it
``plan`` makes placements for whole runs of equal pieces; the pieces themselves are numbered
within their length on Spark and look up their placement.

Reduction. For a length ``j`` with room ``r = capacity - j`` a set is fixed for good when it
dominates every other set that can hold ``j``:

* nothing fits beside it: alone
* a piece of exactly ``r`` exists: with that
* only one piece fits beside it: with the largest that fits
* at most two pieces fit, and no two together are longer than the largest single one: with that one

Rules are applied from the longest length down, again and again until none applies. The rest
is packed longest first, each piece into the fullest sequence that still takes it.

* null text counts as empty and holds the end id alone
* rows that repeat an id are packed each; an empty table gives no rows; other columns are ignored
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from galley.llm.common import Stage, id_and_text, map_batches, utf8
from galley.llm.word_ids import encoder

_PLAN = "length long, first long, pieces long, sequence long, each long, at long"


def cut(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every text, cut only above ``capacity``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            held: list[bytes] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ids = enc.ids(enc.encode(text)).tobytes() + end_id.to_bytes(4, "little")
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for c, v in zip(out, (doc_id, number, at // 4, len(part) // 4, zlib.crc32(part))):
                        out[c].append(v)
                    if with_ids:
                        held.append(part)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(out.values(), kinds)]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(held, pa.binary())] * with_ids, [*out] + ["ids"] * with_ids)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_batches(id_and_text(docs), pieces, schema)


class _Counts:
    """How many pieces of each length are left, and which lengths there are in order."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: n for k, n in counts.items() if n > 0}
        self.lengths = sorted(self.left)
        self.used = dict.fromkeys(self.left, 0)

    def take(self, length: int, n: int) -> int:
        """Take ``n`` pieces of a length; the rank of the first one."""
        first = self.used[length]
        self.used[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            del self.lengths[bisect.bisect_left(self.lengths, length)]
        return first

    def fitting(self, room: int, without: int) -> list[int]:
        """Lengths up to ``room``, leaving out ``without`` if it has only one piece."""
        found = self.lengths[: bisect.bisect_right(self.lengths, room)]
        return [x for x in found if x != without or self.left[x] > 1]

    def smallest(self, without: int, n: int) -> list[int]:
        """The ``n`` smallest pieces besides one of ``without``."""
        out: list[int] = []
        for x in self.lengths:
            out += [x] * min(n, self.left[x] - (x == without))
            if len(out) >= n:
                break
        return out[:n]


def _largest_pair(lengths: list[int], counts: _Counts, without: int, room: int) -> int:
    """The longest two pieces together that ``room`` takes; 0 if none."""
    best, a, b = 0, 0, len(lengths) - 1
    while a <= b:
        both = lengths[a] + lengths[b]
        if both > room:
            b -= 1
            continue
        if a != b or counts.left[lengths[a]] - (lengths[a] == without) > 1:
            best = max(best, both)
        a += 1
    return best


def _partner(counts: _Counts, j: int, capacity: int) -> int | None:
    """The length that dominates beside ``j``; 0 if nothing fits; None if no rule applies."""
    room = capacity - j
    fits = counts.fitting(room, j)
    if not fits:
        return 0
    k = fits[-1]
    if k == room:
        return k
    small = counts.smallest(j, 3)
    if len(small) < 2 or small[0] + small[1] > room:
        return k
    if (len(small) < 3 or sum(small) > room) and _largest_pair(fits, counts, j, room) <= k:
        return k
    return None


def plan(lengths: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Placements for the pieces, given how many there are of each length, and the number of sequences.

    A placement ``(length, first, pieces, sequence, each, at)`` says: the pieces of that length
    from rank ``first`` on go ``each`` to a sequence, from ``sequence`` on, at offset ``at``.
    """
    counts, out, opened = _Counts(lengths), [], 0
    fixed = True
    while fixed:
        fixed = False
        for j in sorted(counts.left, reverse=True):
            while j in counts.left and (k := _partner(counts, j, capacity)) is not None:
                n = counts.left[j] if k == 0 else counts.left[j] // 2 if k == j else min(counts.left[j], counts.left[k])
                if k == j:
                    out.append((j, counts.take(j, 2 * n), 2 * n, opened, 2, 0))
                else:
                    out.append((j, counts.take(j, n), n, opened, 1, 0))
                    if k:
                        out.append((k, counts.take(k, n), n, opened, 1, j))
                opened += n
                fixed = True

    # Best fit, longest first. Sequences with the same room left form runs of consecutive numbers.
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, n))

    for s in sorted(counts.left, reverse=True):
        while s in counts.left:
            n = counts.left[s]
            at = bisect.bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                first, many = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first = capacity, opened
                many = -(-n // (capacity // s))
                opened += many
            each = room // s
            full = min(many, n // each)
            if full:
                out.append((s, counts.take(s, full * each), full * each, first, each, capacity - room))
                leave(room - each * s, first, full)
            rest = n - full * each
            if full < many and rest < each:  # the last pieces of this length share one sequence
                if rest:
                    out.append((s, counts.take(s, rest), rest, first + full, rest, capacity - room))
                    leave(room - rest * s, first + full, 1)
                leave(room, first + full + bool(rest), many - full - bool(rest))
    return out, opened


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored ``pieces`` (``length`` from 1 to ``capacity``).

    A column ``place_``, different in each row, spreads rows that are equal otherwise; it is left out.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows at most
    placements, _ = plan(histogram, capacity)
    # Rank within a length: a common length is dealt over many parts, each numbered by itself.
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = ["doc_id", "piece", "ids_crc32", *[c for c in pieces.columns if c == "place_"]]
    dealt = pieces.withColumn("part_", F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy("length", "part_").count()
    before = Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part_", F.coalesce(F.sum("count").over(before), F.lit(0).cast("long")).alias("base_"))
    within = Window.partitionBy("length", "part_").orderBy(*spread)
    ranked = (
        dealt.withColumn("rank_", F.row_number().over(within) - 1)
        .join(bases, ["length", "part_"])
        .withColumn("rank_", F.col("base_") + F.col("rank_"))
    )
    # The plan's size follows the capacity, not the data: it may be sent to every task.
    moves = F.broadcast(spark.createDataFrame(placements, _PLAN).withColumnRenamed("length", "length_"))
    inside = (F.col("length") == F.col("length_")) & (F.col("rank_") >= F.col("first")) & (
        F.col("rank_") < F.col("first") + F.col("pieces")
    )
    nth = F.col("rank_") - F.col("first")
    return ranked.join(moves, inside).select(
        *[c for c in pieces.columns if c != "place_"],
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Cut, encode and place whole texts; one row per piece."""
    stage = Stage(docs.sparkSession, "packing")
    pieces = cut(docs, vocabulary, end_id, capacity, with_ids).withColumn("place_", F.monotonically_increasing_id())
    return place(stage.save(pieces, "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` (little-endian 32-bit): the packed sequences themselves, ``capacity`` ids at most each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, binary(''), (a, p) -> concat(a, p.ids))").alias("ids")
    )

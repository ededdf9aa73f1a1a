"""Token ids in binary blocks with Elias-Fano coded document boundaries.

A store is a folder with two Parquet tables:

``blocks``  one row per block of consecutive documents, in ascending doc_id order
            part, block      place of the block: range partition, number within it
            doc_ids          ids of its documents (delta-coded by Parquet)
            n_ids, width     ids in the block, bytes per id (2 if the vocabulary fits)
            ids              the concatenated ids, little endian
            low_bits         bits per boundary in ``low``
            low, high        Elias-Fano code of the documents' ends: low bits packed, high bits unary
            samples          place in ``high`` of every 64th set bit, for select
``bases``   part, block, base: ids of all blocks before; 64-bit only here, once per block

An end takes about 2 + log2(mean tokens) bits. ``EliasFano.select`` gives one boundary without
decoding the block.

* null text counts as empty and holds the end id alone; null ids come first
* rows that repeat an id are kept, ordered by text
* a document longer than a block gets a block of its own; an empty table gives empty tables
* other columns are ignored
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from galley.llm.common import id_and_text, map_batches, utf8
from galley.llm.word_ids import encoder

_SAMPLE = 64
BLOCK_BYTES = 1 << 18
_BLOCKS = (
    "part int, block int, doc_ids array<long>, n_ids long, width int, ids binary, "
    "low_bits int, low binary, high binary, samples binary"
)


class EliasFano:
    """A rising sequence of integers in about ``2 + log2(last / count)`` bits each."""

    def __init__(self, count: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.low_bits = count, low_bits
        self.low = np.frombuffer(low, dtype=np.uint8)
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.samples = np.frombuffer(samples, dtype="<u4")

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        count = len(values)
        last = int(values[-1]) if count else 0
        low_bits = max(0, (last // max(count, 1)).bit_length() - 1)
        values = values.astype(np.int64)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (values >> low_bits) + np.arange(count)
        unary = np.zeros(int(places[-1]) + 1 if count else 0, dtype=np.uint8)
        unary[places] = 1
        return cls(
            count, low_bits, low.tobytes(), np.packbits(unary, bitorder="little").tobytes(),
            places[::_SAMPLE].astype("<u4").tobytes(),
        )

    def _low(self, i: int) -> int:
        at, end = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[at // 8 : (end + 7) // 8].tobytes(), "little")
        return (word >> (at % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The value of number ``i``: from the nearest sample on, count set bits."""
        place = int(self.samples[i // _SAMPLE])
        skip = i % _SAMPLE
        while True:
            byte = int(self.high[place // 8]) >> (place % 8)
            ones = byte.bit_count()
            if skip < ones:
                break
            skip -= ones
            place += 8 - place % 8
        for _ in range(skip):
            byte &= byte - 1
        place += (byte & -byte).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.count]
        out = (places - np.arange(self.count)) << self.low_bits
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[: self.count * self.low_bits]
            out |= bits.reshape(self.count, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))
        return out


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode every whole text, append ``end_id`` to each, write the store under ``path``.

    Texts are moved once, to range partitions on doc_id; each task then streams its partition.
    Rows of one id (or of none) are divided further by a hash of their texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        part, block = TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        doc_ids, packed, size = [], [], 0

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(p) // enc.width for p in packed])
            code = EliasFano.build(ends)
            values = [part, block, doc_ids, int(ends[-1]), enc.width, b"".join(packed),
                      code.low_bits, code.low.tobytes(), code.high.tobytes(), code.samples.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(),
                     pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = [f.split()[0] for f in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                data = enc.encode(text) + end
                if packed and size + len(data) > BLOCK_BYTES:
                    yield row()
                    block, doc_ids, packed, size = block + 1, [], [], 0
                doc_ids.append(doc_id)
                packed.append(data)
                size += len(data)
        if packed:
            yield row()

    spark = docs.sparkSession
    ordered = id_and_text(docs).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    (
        map_batches(ordered, encode, _BLOCKS)
        .write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(f"{path}/blocks")
    )
    # Two-level prefix sums: within a part over its blocks, and over the parts.
    counts = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").select("part", "block", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    bases = counts.join(
        parts.select("part", F.coalesce(F.sum("part_ids").over(before), zero).alias("part_base")), "part"
    ).select(
        "part", "block", (F.col("part_base") + F.coalesce(F.sum("n_ids").over(within), zero)).alias("base")
    )
    bases.write.parquet(f"{path}/bases")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files alone.

    ``ids_crc32`` is taken over the ids as little-endian unsigned 32-bit integers.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                ends = EliasFano(len(block["doc_ids"]), block["low_bits"], block["low"], block["high"], block["samples"]).values()
                starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
                ids = np.frombuffer(block["ids"], dtype=f"<u{block['width']}").astype("<u4")
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["doc_ids"], pa.int64()), pa.array(starts + block["base"]),
                     pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    bases = spark.read.schema("part int, block int, base long").parquet(f"{path}/bases")
    joined = blocks.join(F.broadcast(bases) if _small(bases) else bases, ["part", "block"])
    return map_batches(joined, decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` (array of int) per document, for readers that want the ids themselves."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                block = {name: batch.column(name)[r].as_py() for name in batch.schema.names}
                code = EliasFano(len(block["doc_ids"]), block["low_bits"], block["low"], block["high"], block["samples"])
                ids = np.frombuffer(block["ids"], dtype=f"<u{block['width']}").astype("<i4")
                offsets = np.concatenate(([0], code.values())).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                    ["doc_id", "ids"],
                )

    return map_batches(spark.read.schema(_BLOCKS).parquet(f"{path}/blocks"), decode, "doc_id long, ids array<int>")


def _small(bases: DataFrame, limit: int = 200_000) -> bool:
    """Whether the block list (16 bytes a row) may be broadcast; beyond it the join shuffles."""
    return bases.limit(limit + 1).count() <= limit

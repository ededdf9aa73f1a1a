"""Importance resampling towards a target corpus, by hashed features found with an Aho-Corasick dictionary.

A feature is a run of one to ``max_n`` adjacent words, joined by one space; its bucket is its
CRC-32 modulo the number of buckets. Features are never cut out of a text:

1. Dictionary. A worker keeps an Aho-Corasick automaton of distinct words, each bounded by
   delimiters on both sides. The payload of a word is the CRC-32 and the length of its bytes.
2. Scan. One pass of the automaton over the delimited bytes of many texts emits the payloads in
   order. Words not seen before are added first, so no word of a text is without a payload.
3. Composition. The CRC of a longer feature follows from the payloads of its words alone: that of
   the first ones, shifted by the length of the next one, plus that of the next one.
4. Bucket counts are summed within a task, then over tasks: rows by the number of buckets, not
   by the data. The gain of a bucket is its smoothed log ratio between target and raw corpus.
5. A document's weight is the sum of its features' gains, its score adds Gumbel noise from a hash
   of its id, and the documents with the highest scores are drawn: sampling without replacement
   in proportion to the importance. Ranks come from range partitions, so no task sees all rows.

The dictionary holds ``DICTIONARY_WORDS`` words at most and is begun anew beyond that; words
longer than ``LONG_WORD`` bytes get their payload on the spot. Both bound memory only.

* null text has no words: no features, weight 0, and it is never drawn (fewer than ``least_words``)
* a null doc_id takes part; its noise is that of an empty id, and it loses ties
* repeated rows each get a row and, where drawn, a rank of their own
* very long texts are scanned in stretches of bounded size, cut at delimiters
* other columns are ignored; an empty table gives no rows, an empty target corpus only smoothed gains
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from galley.llm.common import Stage, id_and_text, map_batches, utf8
from galley.operators.ranking import number_rows

DICTIONARY_WORDS = 150_000
LONG_WORD = 64
_STRETCH = 4 << 20  # bytes that are scanned at once
_LONG = re.compile(rb"[^ ]{%d,}" % (LONG_WORD + 1))

# A-Z become a-z; all ASCII but letters and digits delimits words.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def _zeros(crc: np.ndarray) -> np.ndarray:
    """The remainder after one more zero byte, by eight steps of one bit."""
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return crc


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        table[0][crc & np.uint32(255)] ^ table[1][(crc >> np.uint32(8)) & np.uint32(255)]
        ^ table[2][(crc >> np.uint32(16)) & np.uint32(255)] ^ table[3][crc >> np.uint32(24)]
    )


@lru_cache(maxsize=4096)
def _shift(length: int) -> np.ndarray:
    """Four tables of 256: what every byte of a remainder becomes after ``length`` more bytes."""
    if length == 1:
        return np.stack([_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * i)) for i in range(4)])
    half = _shift(length // 2)
    twice = _apply(half, half)
    return _apply(_shift(1), twice) if length % 2 else twice


def joined(crc: np.ndarray, next_crc: np.ndarray, next_length: np.ndarray) -> np.ndarray:
    """CRC-32 of each text followed by the next one, from both CRCs and the length of the next."""
    out = np.empty_like(crc)
    order = np.argsort(next_length, kind="stable")
    lengths, starts = np.unique(next_length[order], return_index=True)
    for length, part in zip(lengths.tolist(), np.split(order, starts[1:])):
        out[part] = _apply(_shift(length), crc[part]) if length else crc[part]
    return out ^ next_crc


class Dictionary:
    """Payloads of all words of delimited bytes, by an automaton that grows with the words it meets."""

    def __init__(self, most: int = DICTIONARY_WORDS):
        self.most = most
        self._empty()

    def _empty(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.known: dict[bytes, int] = {}
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _learn(self, words: set[bytes]) -> None:
        new = words - self.known.keys()
        if not new:
            return
        if self.known and len(self.known) + len(new) > self.most:
            self._empty()
            new = words
        for word in new:
            self.automaton.add_word(f" {word.decode('latin-1')} ", len(self.known))
            self.known[word] = len(self.known)
        self.automaton.make_automaton()
        added = list(new)
        self.crc = np.append(self.crc, np.array([zlib.crc32(w) for w in added], np.uint32))
        self.length = np.append(self.length, np.array([len(w) for w in added], np.int64))

    def scan(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """End, CRC and length of every word of folded ``data``, in order."""
        words = set(data.split())
        longs = [] if max(map(len, words), default=0) <= LONG_WORD else list(_LONG.finditer(data))
        self._learn({w for w in words if len(w) <= LONG_WORD} if longs else words)
        text = f" {data.decode('latin-1')} "
        if self.known:
            emitted = np.fromiter((x for pair in self.automaton.iter(text) for x in pair), np.int64).reshape(-1, 2)
        else:
            emitted = np.zeros((0, 2), np.int64)
        end, which = emitted[:, 0] - 1, emitted[:, 1]  # one delimiter was put before the data
        crc, length = self.crc[which], self.length[which]
        if longs:
            end = np.append(end, [m.end() for m in longs])
            crc = np.append(crc, np.array([zlib.crc32(m[0]) for m in longs], np.uint32))
            length = np.append(length, [m.end() - m.start() for m in longs])
            order = np.argsort(end, kind="stable")
            end, crc, length = end[order], crc[order], length[order]
        return end, crc, length


@lru_cache(maxsize=1)
def _dictionary() -> Dictionary:
    return Dictionary()


def _stretches(texts: list[bytes], size: int) -> Iterator[tuple[list[int], bytes]]:
    """Folded texts, several in a row and divided by delimiters, or parts of one long text.

    With each stretch come the numbers of its texts, each with the place where it ends.
    """
    held: list[bytes] = []
    owners: list[tuple[int, int]] = []
    at = 0
    for i, raw in enumerate(texts):
        data = raw.translate(_FOLD)
        start = 0
        while start < len(data) or not data:
            stop = len(data)
            if stop - start > size:  # cut after a delimiter, or after the one word that is longer
                cut = data.rfind(b" ", start, start + size)
                stop = cut + 1 if cut >= start else (data.find(b" ", start + size) + 1 or len(data))
            part = data[start:stop]
            held.append(part)
            at += len(part) + 1
            owners.append((i, at))
            start = stop
            if at >= size:
                yield owners, b" ".join(held)
                held, owners, at = [], [], 0
            if not data:
                break
    if owners:
        yield owners, b" ".join(held)


def features(texts: list[bytes], max_n: int, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of words of each text, and the buckets of all its features, longer ones after shorter ones."""
    n_words = np.zeros(len(texts), np.int64)
    crcs: list[list[np.ndarray]] = [[] for _ in texts]
    lengths: list[list[np.ndarray]] = [[] for _ in texts]
    for owners, data in _stretches(texts, _STRETCH):
        end, crc, length = _dictionary().scan(data)
        cuts = np.searchsorted(end, [place for _, place in owners], side="left")
        for (i, _), a, b in zip(owners, [0, *cuts.tolist()], cuts.tolist()):
            n_words[i] += b - a
            crcs[i].append(crc[a:b])
            lengths[i].append(length[a:b])
    out = []
    for crc_parts, length_parts in zip(crcs, lengths):
        crc = crc_parts[0] if len(crc_parts) == 1 else np.concatenate(crc_parts)
        found = [crc % np.uint32(buckets)]
        if max_n > 1 and len(crc) > 1:
            length = length_parts[0] if len(length_parts) == 1 else np.concatenate(length_parts)
            spaced = joined(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, length)
            run = crc
            for n in range(2, min(max_n, len(crc)) + 1):
                run = joined(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1)
                found.append(run % np.uint32(buckets))
        out.append(found[0] if len(found) == 1 else np.concatenate(found))
    return n_words, out


def bucketed(docs: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """``doc_id, n_words, n_features, found`` of every row; ``found`` holds little-endian bucket numbers."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, found = features(utf8(batch.column(1)), max_n, buckets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([f.astype(kind).tobytes() for f in found], pa.binary())],
                ["doc_id", "n_words", "n_features", "found"],
            )

    return map_batches(id_and_text(docs), run, "doc_id long, n_words long, n_features long, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features lie in each bucket, over all rows; the driver gets ``buckets`` rows at most."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    rows = map_batches(found.select("found"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Floor of ``scale`` times the smoothed log ratio of target to raw shares, for each bucket."""
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def _weighed(found: DataFrame, gain: np.ndarray, buckets: int) -> DataFrame:
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = [int(gain[np.frombuffer(p, kind)].sum()) for p in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return map_batches(found.select("doc_id", "n_words", "n_features", "found"), run, "doc_id long, n_words long, n_features long, weight long")


def _noise(seed: int, scale: int) -> Column:
    """Floor of ``scale`` times a Gumbel number, from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    max_n: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    scale: int = 1000,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` for every row of ``docs`` (doc_id, text).

    ``target``: rows with a ``text``. Of the documents with at least ``least_words`` words the
    ``percent`` with the highest scores are drawn and ranked from 1, ties to the smaller id;
    the others have no rank.
    """
    stage = Stage(docs.sparkSession, "importance")
    found = stage.save(bucketed(docs, max_n, buckets), "found")
    wanted = bucketed(target.select(F.lit(0).alias("doc_id"), "text"), max_n, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), scale)
    scored = _weighed(found, gain, buckets).withColumn("score", F.col("weight") + _noise(seed, scale))
    # A place for each row, stored with it: equal rows are told apart when they are dealt out.
    scored = stage.save(scored.withColumn("place", F.monotonically_increasing_id()), "scored")
    stage.free("found")
    eligible = F.col("n_words") >= least_words
    drawn = percent * scored.filter(eligible).count() // 100
    ranked = number_rows(scored.filter(eligible), [F.desc("score"), F.col("doc_id").asc_nulls_last(), "place"], name="rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")
    rest = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(rest).drop("place")

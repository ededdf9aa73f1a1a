"""Substrings of a given length that start more than once, by sampled, externally sorted suffixes.

A full suffix array holds 12 bytes or more per character, several times the input. Only common
prefixes of ``length`` symbols matter here, so sorting is induced from a sample, level by level,
and each level goes on only with suffixes that share a long enough prefix with another one:

1. Sample. Of the positions a ``length``-symbol substring covers, the one with the smallest hash
   of a few symbols is its anchor (the leftmost on a tie): equal substrings have equal anchors at
   equal distances. This plays the part of the local minima in induced sorting. Substrings with
   the same anchor are taken together in chunks of ``CHUNK`` starts.
2. Level 1. Each chunk gives one tuple: document, starts, the name of the suffix prefix that all
   its substrings share (common prefix ``length - CHUNK + 1``) and the name of the whole stretch.
   Sorting by name brings equal prefixes together. A tuple whose prefix is alone is dropped, with
   all its substrings. A chunk whose whole stretch occurs twice repeats throughout.
3. Level 2. In the classes that are left over, the starts inside a chunk are induced one by one:
   their names have the full common prefix ``length``. Of chunks that are equal throughout, one
   stands for all (if only repeats across documents count: one at each end, and every chunk of
   a stretch that stays in one document).

Names are hashes instead of ranks; the tuples, never the texts, are sorted. What decides that two
strings are equal has 128 bits: prefix and whole stretch in level 1, two independent hashes in level 2;
a prefix alone, of 64 bits, only leads to further looks. The sorts are
Spark's: runs on disk, merged by priority queues, with the shuffle in front; a name that very
many tuples share is counted before the shuffle and split in the join. Every level is written
to the shared folder, so shards may be far larger than memory and executors may be lost.

A symbol is a byte, or a word (a run of bytes other than space and 0x09 to 0x0D).

* null text counts as empty; texts shorter than ``length`` symbols have no spans
* equal rows are documents of their own and repeat each other; null ids take part
* matches never cross documents; overlapping occurrences in one document count
* other columns are ignored; an empty table gives no rows
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from galley.llm.common import Stage, boxed, id_and_text, map_batches, splittable, utf8
from galley.llm.rolling import SECOND_BASE, Rolling, U, mix, sliding_argmin, word_hashes


@dataclass(frozen=True)
class Unit:
    """What a symbol is, and how many make an anchor and a chunk."""

    name: str
    gram: int
    chunk: int


BYTES, WORDS = Unit("bytes", 16, 64), Unit("words", 4, 8)
_KEY = ["doc_id", "text_key"]


class _Text:
    """A text as symbols, with hashes of its substrings and the bytes that symbols cover."""

    def __init__(self, data: bytes, unit: Unit):
        self.data = data
        if unit.name == "bytes":
            self.symbols, self.starts, self.ends = np.frombuffer(data, dtype=np.uint8), None, None
        else:
            self.symbols, self.starts, self.ends = word_hashes(data)
        self.rolling = Rolling(self.symbols)
        self.n = self.rolling.n

    def names(self, start: np.ndarray, end: np.ndarray, scope: np.uint64) -> list[np.ndarray]:
        """Two independent hashes of substrings, 128 bits together."""
        both = (self.rolling, Rolling(self.second(), SECOND_BASE))
        return [mix(r.of(start, end) + scope) for r in both]

    def second(self) -> np.ndarray:
        """The symbols for the second hash; words are hashed anew, or equal first hashes would stay equal."""
        if self.starts is None:
            return self.symbols
        return Rolling(np.frombuffer(self.data, dtype=np.uint8), SECOND_BASE).of(self.starts, self.ends)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))


def _chunks(text: _Text, unit: Unit, length: int) -> tuple[np.ndarray, ...]:
    """First and last start, name of the shared prefix and of the whole stretch, for every chunk."""
    anchor = sliding_argmin(text.rolling.all_of(unit.gram), length - unit.gram + 1)
    start = np.arange(len(anchor))
    part = (anchor - start) // unit.chunk
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    shared = anchor[first] - part[first] * unit.chunk
    prefix = text.rolling.of(shared, shared + length - unit.chunk + 1)
    whole = mix(text.rolling.of(first, last + length) + (anchor[first] - first).astype(U))
    return first, last, prefix, whole


def _scope(value: int) -> np.uint64:
    return U(value & ((1 << 64) - 1))


def _tuples(docs: DataFrame, unit: Unit, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [], []
            for data, scope in zip(utf8(batch.column(2)), batch.column(3).to_pylist()):
                text = _Text(data, unit)
                rows = _chunks(text, unit, length) if text.n >= length else tuple(np.zeros(0, dtype=t) for t in ("i8", "i8", "u8", "u8"))
                found.append((*rows[:2], *(mix(r.astype(U) + _scope(scope)) for r in rows[2:])))
                counts.append(len(rows[0]))
            at = pa.array(np.repeat(np.arange(len(counts)), counts))
            first, last, prefix, whole = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                 pa.array(prefix.astype(U).view(np.int64)), pa.array(whole.astype(U).view(np.int64))],
                [*_KEY, "first", "last", "prefix", "whole"],
            )

    return map_batches(docs, run, "doc_id long, text_key long, first int, last int, prefix long, whole long")


def _induced(texts: DataFrame, unit: Unit, length: int) -> DataFrame:
    """``doc_id, text_key, first, name, check`` of every single start in ``chunks`` of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, starts, counts = [], [], []
            for data, scope, chunks in zip(utf8(batch.column(2)), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                at = np.unique(np.concatenate([np.arange(c["first"], c["last"] + 1) for c in chunks]))
                names.append(_Text(data, unit).names(at, at + length, _scope(scope)))
                starts.append(at)
                counts.append(len(at))
            if not counts:
                continue
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(starts).astype(np.int32)),
                 *[pa.array(np.concatenate(n).view(np.int64)) for n in zip(*names)]],
                [*_KEY, "first", "name", "check"],
            )

    return map_batches(texts, run, "doc_id long, text_key long, first int, name long, check long")


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["id_"]) & (left["text_key"] == right["key_"])


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"doc_id": "id_", "text_key": "key_"})


def repeated_starts(docs: DataFrame, length: int, unit: Unit, stage: Stage, apart: bool = False) -> DataFrame:
    """``doc_id, text_key, runs``: the starts ``first`` to ``last`` of repeated substrings of each text.

    ``docs``: doc_id, text_key, text, scope. Only texts of the same scope (a long) are compared.
    ``apart``: count only substrings that occur in different documents.
    Texts without repeats have no row.
    """
    place = F.struct(*_KEY)
    again = F.min(place) != F.max(place) if apart else F.count("*") > 1
    tuples = stage.save(_tuples(docs.select(*_KEY, "text", "scope"), unit, length), "tuples")
    shared = tuples.groupBy("prefix").agg(again.alias("again")).filter("again").select("prefix")
    left = stage.save(tuples.join(splittable(shared), "prefix"), "left")
    stage.free("tuples")

    # One row per different stretch: whether it repeats, and where it occurs (at the two ends if in different documents).
    where = F.struct(*_KEY, "first", "last")
    ends = F.array_distinct(F.array(F.min(where), F.max(where))) if apart else F.array(F.min(where))
    stretches = stage.save(left.groupBy("prefix", "whole").agg(again.alias("again"), ends.alias("ends")), "stretches")
    throughout = left.join(splittable(stretches.filter("again").select("prefix", "whole")), ["prefix", "whole"]).select(*_KEY, "first", "last")
    throughout = stage.save(throughout, "throughout")
    if not apart:
        stage.free("left")
    open_ = stretches.filter("not again").select("prefix").distinct()
    chunks = stretches.join(splittable(open_), "prefix").select(F.explode("ends").alias("one")).select("one.*")
    if apart:  # A stretch of one document only may occur there many times; each of them is induced.
        own = stretches.filter("not again").select("prefix", "whole")
        chunks = chunks.union(left.join(splittable(own), ["prefix", "whole"]).select(*_KEY, "first", "last"))
    chunks = chunks.groupBy(*_KEY).agg(F.collect_set(F.struct("first", "last")).alias("chunks"))
    chunks = stage.save(_keyed(chunks), "chunks")
    stage.free("stretches", *(["left"] if apart else []))

    single = docs.join(chunks, _same(docs, chunks)).select(*_KEY, "text", "scope", "chunks")
    single = stage.save(_induced(single, unit, length), "single")
    names = ["name", "check"]
    twice = single.groupBy(*names).agg(again.alias("again")).filter("again").select(*names)
    single = single.join(splittable(twice), names).select(*_KEY, "first", F.col("first").alias("last"))
    runs = throughout.union(single).groupBy(*_KEY).agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    runs = stage.save(runs, "runs")
    stage.free("throughout", "chunks", "single")
    return runs


def covered(runs: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal spans of symbols that the substrings at ``runs`` cover."""
    if not runs:
        return []
    first = np.array([r["first"] for r in runs])
    order = np.argsort(first)
    first, end = first[order], np.array([r["last"] for r in runs])[order] + length
    reach = np.maximum.accumulate(end)
    new = np.ones(len(first), dtype=bool)
    new[1:] = first[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return [(int(first[a]), int(reach[b - 1])) for a, b in zip(at, np.append(at[1:], len(first)))]


def _spans(text: _Text, runs: list[dict], length: int) -> list[tuple[int, int]]:
    return [text.span(a, b) for a, b in covered(runs, length)]


def _with_runs(docs: DataFrame, length: int, unit: Unit) -> DataFrame:
    """``docs`` with all columns, ``text_key`` and ``runs`` (null if nothing repeats)."""
    stage = Stage(docs.sparkSession, "suffixes")
    keyed = id_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text", F.lit(0).cast("long").alias("scope"))
    return _keyed(repeated_starts(keyed, length, unit, stage))


def without_repeats(docs: DataFrame, length: int, unit: Unit = BYTES) -> DataFrame:
    """Per document the bytes that stay after removing all that repeated substrings cover.

    ``doc_id, n_bytes, spans, kept``: spans are the maximal removed byte ranges, ``kept`` the
    remaining bytes (which need not be valid UTF-8 when the unit is bytes).
    """
    keyed = id_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    runs = _with_runs(docs, length, unit)
    joined = keyed.join(runs, _same(keyed, runs), "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, sizes = [], [], []
            for data, found in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                own = _spans(_Text(data, unit), found, length) if found else []
                spans.append([{"start": a, "end": b} for a, b in own])
                kept.append(_remaining(data, own))
                sizes.append(len(data))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    return map_batches(joined, run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _remaining(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def digest(result: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, text`` of ``without_repeats``.

    ``text`` is what is left, as text; bytes of a character that was cut in two become U+FFFD.
    """
    return result.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def cleaned(docs: DataFrame, length: int, unit: Unit = WORDS) -> DataFrame:
    """``docs`` with its columns, repeated passages cut out of ``text`` at word borders.

    ``n_chars``, where there is one, follows the text. Null text stays null.
    """
    runs = _with_runs(docs, length, unit)
    rows = boxed(docs)
    rows = rows.join(runs, rows["doc_id"].eqNullSafe(runs["id_"]) & (F.xxhash64("text") == runs["key_"]), "left")

    @F.pandas_udf("string")
    def cut(texts, found):
        out = []
        for text, own in zip(texts, found):
            if own is not None and len(own):
                data = text.encode()
                text = _remaining(data, _spans(_Text(data, unit), list(own), length)).decode()
            out.append(text)
        return texts.__class__(out, dtype=object)

    text = F.when(F.col("runs").isNotNull(), cut("text", "runs"))
    rows = rows.select("row", text.alias("cut"))
    changed = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("cut").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[
        F.when(F.col("cut").isNotNull(), changed[c]).otherwise(F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ])

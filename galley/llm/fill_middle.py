"""Fill-in-the-middle: cut texts at two random token borders and reorder the three parts.

A unit is a run of ASCII letters or any other single code point. The cuts are drawn as numbers
of units, so the place of the k-th unit has to be found:

1. The bytes of a text are divided into blocks of fixed size. For each block the units and the
   code points that start in it are counted.
2. A Fenwick tree over the blocks holds both counts. Descending it by binary lifting gives the
   block in which a unit starts, with the units and code points before that block.
3. Inside the block the border is found from the block's own bytes.

The tree is small (two counts a block) and is built in slabs of blocks, so a text far longer
than a slab needs no arrays of its own length.

* null text counts as empty; empty texts and texts that hold a sentinel stay plain
* the cuts and the form follow from seed and id alone; a null id counts as an empty one
* repeated rows and repeated ids each give a row; other columns are ignored
* an empty table gives no rows
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from galley.llm.common import id_and_text, map_batches, utf8

BLOCK = 2048  # bytes
_SLAB = 256  # blocks that are counted at once


@dataclass(frozen=True)
class Scheme:
    """Sentinels and shares: ``plain`` percent stay as they are, ``spm`` percent of the others put the suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    plain: int = 10
    spm: int = 20


def _starts(raw: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Where units and where code points start, as flags; ``before`` is the byte in front of ``raw``."""
    letter = ((raw | 32) - np.uint8(97)) < 26
    point = (raw & 0xC0) != 0x80
    follows = np.empty_like(letter)
    follows[1:] = letter[:-1]
    follows[0] = chr(before).isalpha() and before < 128
    return point & ~(letter & follows), point


class Borders:
    """The borders between the units of one text."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.raw, self.block, self.size = np.frombuffer(data, np.uint8), block, len(data)
        blocks = -(-self.size // block)
        counts = np.zeros((2, blocks + 1), np.int64)
        for at in range(0, blocks, _SLAB):
            a, b = at * block, min((at + _SLAB) * block, self.size)
            edges = np.arange(0, b - a, block)
            for row, flags in zip(counts, _starts(self.raw[a:b], self._before(a))):
                row[at + 1 : at + 1 + len(edges)] = np.add.reduceat(flags, edges, dtype=np.int64)
        self.units, self.points = (int(x) for x in counts.sum(axis=1))
        # Fenwick tree: node i holds the sum of the lowbit(i) blocks that end with block i.
        total, node = np.cumsum(counts, axis=1), np.arange(blocks + 1)
        self.tree = total - total[:, node - (node & -node)]
        self.top = 1 << max(blocks.bit_length() - 1, 0)

    def _before(self, at: int) -> int:
        return int(self.raw[at - 1]) if at else 0

    def find(self, unit: int) -> tuple[int, int]:
        """Byte and code point at which unit number ``unit`` (from 0) starts; the end of the text beyond the last."""
        if unit >= self.units:
            return self.size, self.points
        at, step, units, points = 0, self.top, unit, 0
        while step:
            after = at + step
            if after < self.tree.shape[1] and self.tree[0, after] <= units:
                at = after
                units -= int(self.tree[0, at])
                points += int(self.tree[1, at])
            step >>= 1
        start = at * self.block
        unit_flags, point_flags = _starts(self.raw[start : start + self.block], self._before(start))
        inside = int(np.flatnonzero(unit_flags)[units])
        return start + inside, points + int(point_flags[:inside].sum())


def _drawn(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(text[8 * i : 8 * i + 8], 16) for i in range(4))


def transform(data: bytes, doc_id: int | None, seed: int, scheme: Scheme) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (none if plain), and the output of one text."""
    borders = Borders(data)
    h1, h2, h3, h4 = _drawn(seed, doc_id)
    marks = [m.encode() for m in (scheme.prefix, scheme.suffix, scheme.middle)]
    if not data or any(m in data for m in marks) or h3 % 100 >= 100 - scheme.plain:
        return borders.units, "plain", None, None, data
    a, b = sorted((h1 % (borders.units + 1), h2 % (borders.units + 1)))
    (first, first_point), (second, second_point) = borders.find(a), borders.find(b)
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    p, s, m = marks
    spm = h4 % 100 < scheme.spm
    output = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
    return borders.units, "spm" if spm else "psm", first_point, second_point - first_point, output


def fill_in_middle(docs: DataFrame, seed: int = 1, scheme: Scheme = Scheme()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [transform(t, i, seed, scheme) for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)))]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)],
                 pa.array([m[4] for m in made], pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return map_batches(id_and_text(docs), run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(scheme: Scheme = Scheme()) -> Column:
    """The text as it was, from the columns ``output`` and ``form`` alone."""
    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        """The parts after the first, second and third sentinel."""
        one, two, three = len(first), len(second), len(scheme.middle)
        output = F.col("output")
        # The first occurrence is the sentinel: no part holds one, and none can arise across a border.
        at, last = F.locate(second, output, 1), F.locate(scheme.middle, output, 1)
        return (
            F.substring(output, F.lit(one + 1), at - F.lit(one + 1)),
            F.substring(output, at + F.lit(two), last - at - F.lit(two)),
            F.substring(output, last + F.lit(three), F.length(output)),
        )

    prefix, suffix, middle = between(scheme.prefix, scheme.suffix)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(scheme.suffix, scheme.prefix)
    spm = F.concat(prefix, middle, suffix)
    return F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output"))

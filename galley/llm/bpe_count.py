"""Token counts by byte-pair merging on a heap and a linked list, without token ids.

The vocabulary file gives the merges; nothing is trained. For a piece of text the number of
tokens is its number of start symbols (bytes) minus the number of merges.

* null text counts as empty: 0 bytes, 0 tokens
* added tokens of the file that occur inside a text count as one token each, as in the library
* repeated rows and repeated or null ids each give a row; other columns are ignored
* an empty table gives no rows
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from galley.llm.common import id_and_text, map_batches, utf8

# The pattern by which the byte-level scheme cuts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space other than single blanks and line ends: such texts are cut by the pattern as a whole.
_UNUSUAL_SPACE = re.compile(
    rb"[ \n][ \n]|[\t\r\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_CACHE_LIMIT = 600_000  # entries a worker keeps; only memory depends on it, not the counts


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of every byte: printable Latin-1 bytes stay, the others follow from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in kept}
    for b in range(256):
        names.setdefault(b, chr(256 + len(names) - len(kept)))
    return names


class MergeCounter:
    """Counts the tokens of texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        numbers: dict[str, int] = {}
        number = lambda s: numbers.setdefault(s, len(numbers))
        names = _byte_symbols()
        self.symbol = [number(names[b]) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((number(left), number(right)), (rank, number(left + right)))
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.added_starts = [t.encode() for t in added]
        self.pattern = regex.compile(PATTERN)
        self.pieces: dict[str, int] = {}
        self.chunks: dict[bytes, int] = {}

    def piece(self, data: bytes) -> int:
        """Tokens of one piece: merge the adjacent pair of lowest rank until none is left."""
        symbols = [self.symbol[b] for b in data]
        n = left = len(symbols)
        if n < 2:
            return n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if found := merges.get((symbols[i], symbols[i + 1])):
                heap.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i]
            # A pair is out of date when either of its symbols was merged since it was pushed.
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if found := merges.get((merged, symbols[k])):
                    heapq.heappush(heap, (found[0], i, merged, symbols[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((symbols[h], merged))):
                heapq.heappush(heap, (found[0], h, symbols[h], merged, found[1]))
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text without added tokens."""
        pieces, total = self.pieces, 0
        for p in self.pattern.findall(text):
            count = pieces.get(p)
            if count is None:
                count = self.piece(p.encode())
                if len(p) <= 64:
                    if len(pieces) >= _CACHE_LIMIT:  # also within one very long text
                        pieces.clear()
                    pieces[p] = count
            total += count
        return total

    def _chunk(self, chunk: bytes) -> int:
        """A stretch between blanks, with the blank before it; one after a line end begins with it."""
        text = chunk.decode()
        count = 1 + self.plain(text[1:]) if text[:1] == "\n" else self.plain(" " + text)
        if len(chunk) <= 96:
            if len(self.chunks) >= _CACHE_LIMIT:
                self.chunks.clear()
            self.chunks[chunk] = count
        return count

    def count(self, data: bytes) -> int:
        if not data:
            return 0
        if self.added and any(t in data for t in self.added_starts):
            text = data.decode()
            parts = self.added.split(text)
            return len(parts) - 1 + sum(self.plain(p) for p in parts)
        if data[0] in b" \n" or data[-1] in b" \n" or _UNUSUAL_SPACE.search(data):
            return self.plain(data.decode())
        # Single blanks and line ends only: the pattern never reaches across a blank or a line end.
        chunks = (b"\n" + data).replace(b"\n", b" \n").split(b" ")
        get, own = self.chunks.get, self._chunk
        total = -1  # the line end put before the text
        for c in chunks[1:]:
            n = get(c)
            total += own(c) if n is None else n
        return total


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs`` (doc_id, text).

    ``vocabulary``: path of a byte-level BPE file in the JSON format of the tokenizers library,
    readable on every executor. A row's work depends on its own text alone: no shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = utf8(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(counter.count, texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return map_batches(id_and_text(docs), count, "doc_id long, n_bytes long, n_tokens long")

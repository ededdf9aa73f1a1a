"""Token ids of whole texts under a word-level BPE file, one library call per distinct word.

The scheme lower-cases and cuts at white space, so a text's ids are its words' ids in a row.
Words are looked up in a bounded table of the worker; new ones go to the tokenizers library.

* null counts as the empty text, which has no ids
* words beyond 64 bytes are encoded each time and never kept, however long they are
* a text is split as a whole: its words take some times its own size in memory, one text at a time
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from galley.llm.bpe_count import _byte_symbols

_LIMIT = 600_000  # words a worker keeps; only memory depends on it
# A lower-case word of letters that normalisation leaves alone, and the ASCII marks after it.
_SIMPLE = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")


class WordEncoder:
    """``encode`` gives the ids of a text as little-endian integers of ``width`` bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.dtype.itemsize
        self.known: dict[bytes, bytes] = {}
        self.names = {c: s for c, s in ((bytes([b]), s) for b, s in _byte_symbols().items())}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _library(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: bytes) -> bytes:
        found = _SIMPLE.fullmatch(word)
        if found is None:
            out = self._library(word.decode())
        elif found[2]:
            letters, marks = found.groups()
            out = (self.known.get(letters) or self._word(letters)) + (self.known.get(marks) or self._word(marks))
        else:
            # One piece already: straight to the library's merges, in the stand-ins of its bytes.
            mapped = "".join([self.names[bytes([b])] for b in word])
            out = self._pack([t.id for t in self.tokenizer.model.tokenize(mapped)])
        if len(word) <= 64:
            if len(self.known) >= _LIMIT:  # also within one very long text
                self.known.clear()
            self.known[word] = out
        return out

    def encode(self, data: bytes) -> bytes:
        if b"<|" in data:  # may hold a special token, whose case matters
            return self._library(data.decode())
        words = data.lower().split()
        get, own = self.known.get, self._word
        return b"".join([get(w) or own(w) for w in words])

    def ids(self, packed: bytes) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit integers."""
        return np.frombuffer(packed, dtype=self.dtype).astype("<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)

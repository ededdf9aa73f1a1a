"""A probabilistic suffix tree over words, learned from the corpus, and the score of every text under it.

Symbols are words, and an end symbol after each text; it also stands before the first word. A state
of the tree is a context of one to ``depth`` preceding symbols:

1. Candidates. A context takes part when it makes up at least ``p_min`` of all training tokens (and
   occurs ``least_count`` times), so there are 1 / ``p_min`` candidates of a length at most, however
   large the corpus. Their successors have no bound and stay in tables. All suffixes of a candidate
   are candidates, so one length follows from the counts of the last one.
2. Smoothing. The distribution after a context of C occurrences and T different successors is
   (c + T * p) / (C + T), where p is the probability after its longest retained suffix. At the root
   it is (c + 1) / (N + V + 1): N tokens, V words, one class for all words never seen.
3. Divergence test. Each occurrence is left out once: the mean of ln(q / p), where q is the smoothed
   estimate without that occurrence, must be at least ``least_gain``. Other contexts are pruned.
4. A text's score adds log10 of each symbol's probability in the state of the longest retained suffix.

Counts and look-ups share one exchange for each length. Texts are kept as blocks of at most
``BLOCK_TOKENS`` tokens, as codes of the block's own dictionary. A block sends its different (context,
successor) pairs with their counts to buckets dealt by a hash of both, so that no context, however
common, is one group; a bucket adds the counts up and answers each block, in the order asked. Words
are counted and numbered in the same way, by exchange of the dictionaries. What is sent is packed:
one row for a block and a bucket.

* null text counts as empty: the end symbol alone
* a null doc_id counts as an empty id where training texts are told from held-out ones
* repeated rows each count and each get a row; other columns are ignored
* very long texts go on from block to block, with the symbols before the cut as context
* without training texts every score is 0; an empty table gives no rows
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from galley.llm.common import Stage, groups, id_and_text, map_batches, utf8
from galley.llm.rolling import U, mix

P_MIN, LEAST_COUNT, LEAST_GAIN, DEPTH = 2e-6, 4, 0.01, 3
BLOCK_TOKENS = 1 << 18
BUCKET_PAIRS = 1 << 21
_STRETCH = 1 << 22  # bytes of a text that are split into words at once
_END = b""  # no word is empty
_SPACE = re.compile(rb"[\x09-\x0D ]")


def _compressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _plain(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte by byte: first bytes of all values, second bytes, and so on."""
    return _compressed(b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns))


def _unpacked(packed: bytes, *kinds: str) -> list[np.ndarray]:
    data = _plain(packed)
    n, at, out = len(data) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * size
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of a rising column, which take less space; ``np.cumsum`` undoes them."""
    return np.diff(values, prepend=values.dtype.type(0))


# 1. Texts as blocks.


def _words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in stretches of bounded size."""
    at = 0
    while len(data) - at > _STRETCH:
        found = _SPACE.search(data, at + _STRETCH)
        stop = found.start() if found else len(data)
        yield data[at:stop].lower().split()
        at = stop
    yield data[at:].lower().split()


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


class _Writer:
    """Puts texts into blocks of one task."""

    def __init__(self, task: int, depth: int, size: int):
        self.task, self.depth, self.size = task, depth, size
        self.blocks = self.texts = 0
        self._empty()

    def _empty(self) -> None:
        # A word met for the first time takes the next code.
        self.known: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__, {_END: 0})
        self.codes: list[np.ndarray] = []
        self.length = self.scored = 0
        self.parts: list[tuple] = []

    def add(self, doc_id: int | None, held: bool, data: bytes) -> Iterator[pa.RecordBatch]:
        self.texts += 1
        key, before = (self.task << 33) + self.texts, [_END]
        for run in _ended(_words(data)):
            at = 0
            while at < len(run):
                part = run[at : at + max(self.size - self.scored, 1)]
                at += len(part)
                whole, known = before + part, self.known
                self.parts.append((key, doc_id, held, self.length, len(before)))
                self.codes.append(np.fromiter(map(known.__getitem__, whole), np.uint32, len(whole)))
                self.length += len(whole)
                self.scored += len(part)
                before = whole[-self.depth :]
                if self.scored >= self.size:
                    yield self.flush()

    def flush(self) -> pa.RecordBatch:
        keys, ids, held, begins, skips = zip(*self.parts)
        self.blocks += 1
        # The dictionary in the order of the words' hashes: a bucket is a range of hashes, and so of codes.
        words = list(self.known)
        order = np.argsort(_hashes(words), kind="stable")
        code = np.empty(len(words), np.uint32)
        code[order] = np.arange(len(words), dtype=np.uint32)
        codes = code[np.concatenate(self.codes)]
        lengths = np.diff([*begins, len(codes)])
        at = np.arange(len(codes)) - np.repeat(begins, lengths)
        use = (at >= np.repeat(skips, lengths)) & ~np.repeat(held, lengths)
        columns = {
            "block": pa.array([(self.task << 33) + self.blocks], pa.int64()),
            "size": pa.array([self.scored], pa.int64()),
            "words": pa.array([_compressed(b" ".join([words[i] for i in order.tolist()]))], pa.binary()),
            "n": pa.array([_packed(np.bincount(codes[use], minlength=len(words)).astype("<i8"))], pa.binary()),
            "codes": pa.array([_packed(codes.astype("<u4"))], pa.binary()),
            "begins": pa.array([begins], pa.list_(pa.int32())),
            "skips": pa.array([skips], pa.list_(pa.int32())),
            "keys": pa.array([keys], pa.list_(pa.int64())),
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "held": pa.array([held], pa.list_(pa.bool_())),
        }
        self._empty()
        return pa.RecordBatch.from_pydict(columns)


def _ended(runs: Iterator[list[bytes]]) -> Iterator[list[bytes]]:
    """The runs, the last one with the end symbol."""
    last = next(runs)
    for run in runs:
        yield last
        last = run
    yield last + [_END]


_TEXT_COLUMNS = ("begins", "skips", "keys", "doc_ids", "held")
_TEXTS = "begins array<int>, skips array<int>, keys array<long>, doc_ids array<long>, held array<boolean>"


def _blocks(docs: DataFrame, depth: int, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(TaskContext.get().partitionId(), depth, size)
        for batch in batches:
            for doc_id, data, held in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                yield from writer.add(doc_id, held, data)
        if writer.parts:
            yield writer.flush()

    return map_batches(docs, run, f"block long, size long, words binary, n binary, codes binary, {_TEXTS}")


# 2. The tree, as far as it is known, and what a block makes of it.


def _found(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Place of each value in ``ordered``, -1 where it is not there."""
    if not len(ordered):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


@dataclass
class Tree:
    """The contexts. Those of one word are numbered by ``words``; longer ones by ``keys`` of their
    length, a key being (number of the context without its first word, number of the first word)."""

    tokens: int
    kinds: int
    end: int  # the number of the end symbol in the vocabulary
    words: np.ndarray
    keys: list[np.ndarray] = field(default_factory=list)
    total: list[np.ndarray] = field(default_factory=list)
    successors: list[np.ndarray] = field(default_factory=list)
    kept: list[np.ndarray] = field(default_factory=list)

    def size(self, length: int) -> int:
        return len(self.words) if length == 1 else len(self.keys[length - 2])

    def longer(self, shorter: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
        """Numbers of the contexts of ``length`` from the numbers of their two parts; -1 for none."""
        out = np.full(len(shorter), -1, np.int64)
        at = np.flatnonzero((shorter >= 0) & (first >= 0))
        out[at] = _found(shorter[at] * len(self.words) + first[at], self.keys[length - 2])
        return out

    def spelled(self, context: np.ndarray, length: int) -> list[np.ndarray]:
        """The words of contexts, first word first, as numbers of contexts of one word."""
        out = []
        for n in range(length, 1, -1):
            key = self.keys[n - 2][context]
            out.append(key % len(self.words))
            context = key // len(self.words)
        return [*out, context]

    def grow(self, context: np.ndarray, successor: np.ndarray, length: int) -> None:
        """The candidates one longer than ``length``, from frequent pairs of a context and a successor."""
        last = _found(successor, self.words)
        spelled = [*self.spelled(context, length), last]
        shorter = last
        for n, word in enumerate(reversed(spelled[1:-1]), 2):
            shorter = self.longer(shorter, word, n)
        fit = (shorter >= 0) & (spelled[0] >= 0)
        self.keys.append(np.unique((shorter * len(self.words) + spelled[0])[fit]))


class _Block:
    """The tokens of a block with their states, and the pairs that it asks for."""

    def __init__(self, row: dict, tree: Tree):
        self.tree = tree
        self.codes = _unpacked(row["codes"], "<u4")[0].astype(np.int64)
        begins, skips = np.array(row["begins"], np.int64), np.array(row["skips"], np.int64)
        lengths = np.diff(np.append(begins, len(self.codes)))
        self.part = np.repeat(np.arange(len(begins)), lengths)
        self.offset = np.arange(len(self.codes)) - begins[self.part]
        self.scored = self.offset >= skips[self.part]
        self.training = ~np.array(row["held"], bool)[self.part]
        known = [_unpacked(a["data"], "<i8", "<i8") for a in row["known"]]
        self.ids = np.concatenate([np.cumsum(steps) for steps, _ in known])
        self.counts = np.concatenate([count for _, count in known])
        self.answers = row.get("answers") or []

    def states(self) -> Iterator[np.ndarray]:
        """For each length the number of every token's context; -1 where it is no candidate."""
        word = _found(self.ids, self.tree.words)[self.codes]

        def before(n: int) -> np.ndarray:
            out = np.full(len(word), -1, np.int64)
            out[n:] = word[:-n]
            out[self.offset < n] = -1
            return out

        state = before(1)
        yield state
        for n in range(2, len(self.tree.keys) + 2):
            state = self.tree.longer(state, before(n), n)
            yield state

    def pairs(self, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """The tokens whose (context, successor) is known, the different pairs, a token of each, and each token's pair."""
        at = np.flatnonzero(self.scored & (state >= 0) & (self.counts > 0)[self.codes])
        size = len(self.ids)
        both = state[at] * size + self.codes[at]
        order = np.argsort(both)
        new = np.ones(len(at), bool)
        new[1:] = both[order[1:]] != both[order[:-1]]
        pair = np.empty(len(at), np.int64)
        pair[order] = np.cumsum(new) - 1
        one = order[new]
        return at, both[one] // size, both[one] % size, at[one], pair

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
        """For each length: probability of every token in shorter states, its context, and the pairs.

        The probability is then brought up to that length by the answers to it, if there are any.
        """
        tree = self.tree
        self.probability = ((self.counts + 1) / (tree.tokens + tree.kinds + 1))[self.codes]
        for n, state in enumerate(self.states()):
            pairs = self.pairs(state)
            yield self.probability, state, pairs
            if n < len(tree.kept):
                at, context, code, _, pair = pairs
                count = np.zeros(len(self.codes))
                count[at] = self._answered(n, context, self.ids[code])[pair]
                inside = np.flatnonzero((state >= 0) & tree.kept[n][state])
                s = state[inside]
                share = tree.successors[n][s]
                self.probability[inside] = (count[inside] + share * self.probability[inside]) / (tree.total[n][s] + share)

    def _answered(self, n: int, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Counts of the pairs, put together from the answers of the buckets."""
        out = np.zeros(len(context), np.int64)
        answers = self.answers[n] or []
        if answers:
            bucket = _bucket(context, successor, answers[0]["buckets"])
            order = np.argsort(bucket, kind="stable")
            out[order] = np.concatenate([_unpacked(a["data"], "<i8")[0] for a in answers])
        return out


def _bucket(context: np.ndarray, successor: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(mix(context.astype(U) + U(1)) + successor.astype(U)) % U(buckets)).astype(np.int64)


def _with_answers(blocks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """The blocks with all that they have been answered so far."""
    out = blocks
    for n, table in enumerate(answers):
        out = out.join(table.withColumnRenamed("answers", f"answers_{n}"), "block", "left")
    return out.select(*blocks.columns, F.array(*[f"answers_{n}" for n in range(len(answers))]).alias("answers")) if answers else out


def _answers(counted: DataFrame, buckets: int) -> DataFrame:
    """``block, answers``: what all buckets sent back to a block, in their order."""
    answer = F.struct("bucket", F.lit(buckets).alias("buckets"), "data")
    return counted.filter("kind = 'answer'").groupBy("block").agg(F.sort_array(F.collect_list(answer)).alias("answers"))


_COUNTED = "kind string, bucket int, block long, data binary"


def _sent(kinds: list[str], bucket: int, blocks: list[int | None], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds), pa.array([bucket] * len(data), pa.int32()), pa.array(blocks, pa.int64()), pa.array(data, pa.binary())],
        ["kind", "bucket", "block", "data"],
    )


def _at_buckets(asked: DataFrame, buckets: int) -> DataFrame:
    return asked.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")


# 3. Words: dictionaries to buckets, numbers and counts back.


def _asked_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """``bucket, block, words, n``: the part of each block's dictionary that falls to a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            words = _plain(row["words"]).split(b" ")
            (n,) = _unpacked(row["n"], "<i8")
            bucket = (_hashes(words).astype(U) * U(buckets)) >> U(32)
            numbers, starts = np.unique(bucket, return_index=True)
            ends = [*starts[1:].tolist(), len(words)]
            parts = list(zip(starts.tolist(), ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers.astype(np.int32)), pa.array([row["block"]] * len(parts), pa.int64()),
                 pa.array([_compressed(b" ".join(words[a:b])) for a, b in parts], pa.binary()),
                 pa.array([_packed(n[a:b]) for a, b in parts], pa.binary())],
                ["bucket", "block", "words", "n"],
            )

    return map_batches(blocks.select("block", "words", "n"), run, "bucket int, block long, words binary, n binary")


def _counted_words(asked: DataFrame, buckets: int) -> DataFrame:
    """Answers hold number and count of each word (0 if not seen in training), numbers rising with the words'
    hashes as in the dictionaries; ``words`` rows hold those of a bucket, an ``end`` row the number of the end symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("bucket",)):
            bucket = group.column("bucket")[0].as_py()
            parts = [_plain(p).split(b" ") for p in group.column("words").to_pylist()]
            # A block lists words of one hash in the order it met them: those are too few to matter for the space.
            known = sorted(set().union(*parts), key=zlib.crc32)
            known = dict(zip(known, range(len(known))))
            codes = [np.fromiter([known[w] for w in words], np.int64, len(words)) for words in parts]
            total = np.zeros(len(known), np.int64)
            for code, packed in zip(codes, group.column("n").to_pylist()):
                total[code] += _unpacked(packed, "<i8")[0]  # a block names a word once
            ids = (bucket << 32) + np.arange(len(known))
            data = [_packed(_steps(ids[c]), total[c]) for c in codes]
            seen = total > 0
            kinds, blocks = ["answer"] * len(data), group.column("block").to_pylist()
            kinds.append("words")
            data.append(_packed(ids[seen], total[seen]))
            if _END in known:
                kinds.append("end")
                data.append(_packed(ids[known[_END] : known[_END] + 1]))
            yield _sent(kinds, bucket, blocks + [None] * (len(kinds) - len(blocks)), data)

    return map_batches(_at_buckets(asked, buckets), run, _COUNTED)


def _totals(counted: DataFrame) -> tuple[int, int]:
    """Training tokens and different words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [_unpacked(p, "<i8", "<i8")[1] for batch in batches for p in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"tokens": pa.array([sum(int(c.sum()) for c in counts)]), "kinds": pa.array([sum(map(len, counts))])})

    rows = map_batches(counted.filter("kind = 'words'").select("data"), run, "tokens long, kinds long")
    row = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    return row["tokens"], row["kinds"]


def _common(counted: DataFrame, least: int) -> np.ndarray:
    """Sorted numbers of the words that occur often enough: 1 / ``p_min`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                ids, count = _unpacked(packed, "<i8", "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(ids[count >= least])], ["id"])

    return np.sort(map_batches(counted.filter("kind = 'words'").select("data"), run, "id long").toArrow().column("id").to_numpy())


# 4. One length: pairs to buckets, counts back to blocks.


def _asked(blocks: DataFrame, tree: Tree, length: int, buckets: int) -> DataFrame:
    """``bucket, block, pairs``: what each block asks of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            block = _Block(row, tree)
            for n, (probability, _, (at, context, code, first, pair)) in enumerate(block.walk(), 1):
                if n == length:
                    break
            successor = block.ids[code]
            n = np.bincount(pair[block.training[at]], minlength=len(context))
            # What the shorter state gives the successor; at the root its count, which takes less space, tells it.
            shorter = block.counts[code] if length == 1 else probability[first]
            bucket = _bucket(context, successor, buckets)
            order = np.argsort(bucket, kind="stable")
            numbers, starts = np.unique(bucket[order], return_index=True)
            out = [
                _packed(_steps(context[o].astype("<i4")), successor[o].astype("<i8"), n[o].astype("<i8"), shorter[o].astype("<f4"))
                for o in np.split(order, starts[1:])
            ] if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array([row["block"]] * len(out), pa.int64()), pa.array(out, pa.binary())],
                ["bucket", "block", "pairs"],
            )

    return map_batches(blocks, run, "bucket int, block long, pairs binary")


def _counted(asked: DataFrame, buckets: int, least: int) -> DataFrame:
    """Answers hold the count of each pair asked for. Of the pairs seen in training, ``pairs`` rows hold context,
    count and what the shorter state gives the successor, and ``frequent`` rows context and successor of those that
    occur ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("bucket",)):
            parts = [_unpacked(p, "<i4", "<i8", "<i8", "<f4") for p in group.column("pairs").to_pylist()]
            context = np.concatenate([np.cumsum(p[0], dtype=np.int32) for p in parts])
            successor, n, shorter = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            order = np.lexsort((successor, context))
            new = np.ones(len(order), bool)
            new[1:] = (context[order[1:]] != context[order[:-1]]) | (successor[order[1:]] != successor[order[:-1]])
            starts = np.flatnonzero(new)
            total = np.add.reduceat(n[order], starts)
            back = np.empty(len(order), np.int64)
            back[order] = total[np.cumsum(new) - 1]
            cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
            data = [_packed(c) for c in np.split(back, cuts)]
            seen, often = total > 0, total >= least
            one, many = order[starts][seen], order[starts][often]
            data += [_packed(_steps(context[one]), total[seen], shorter[one]), _packed(context[many], successor[many])]
            blocks = group.column("block").to_pylist()
            yield _sent(["answer"] * len(blocks) + ["pairs", "frequent"], group.column("bucket")[0].as_py(), [*blocks, None, None], data)

    return map_batches(_at_buckets(asked, buckets), run, _COUNTED)


def _by_context(pairs: DataFrame, size: int, measure, names: tuple[str, ...]) -> list[np.ndarray]:
    """Sums over the pairs of each context; summed in the tasks, so rows grow with the contexts alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), size))
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                steps, count, shorter = _unpacked(packed, "<i4", "<i8", "<f4")
                context = np.cumsum(steps)
                for row, values in zip(sums, measure(context, count, shorter.astype(float))):
                    row += np.bincount(context, weights=values, minlength=size)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(s[at]) for s in sums]], ["context", *names])

    schema = ", ".join(["context long", *[f"{n} double" for n in names]])
    found = map_batches(pairs.select("data"), run, schema).groupBy("context").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((len(names), size))
    for row, name in zip(out, names):
        row[found.column("context").to_numpy()] = found.column(name).to_numpy()
    return list(out)


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and successors of the pairs that occur often enough: 1 / ``p_min`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                context, successor = _unpacked(packed, "<i4", "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(context.astype(np.int64)), pa.array(successor)], ["context", "successor"])

    found = map_batches(counted.filter("kind = 'frequent'").select("data"), run, "context long, successor long").toArrow()
    return found.column("context").to_numpy(), found.column("successor").to_numpy()


def _test(tree: Tree, pairs: DataFrame, length: int, least_gain: float) -> None:
    """Totals of each context, and which of them the divergence test retains."""
    size = tree.size(length)
    total, successors = _by_context(pairs, size, lambda c, n, p: (n.astype(float), np.ones(len(n))), ("total", "kinds"))

    def left_out(context: np.ndarray, n: np.ndarray, shorter: np.ndarray) -> list[np.ndarray]:
        p = (shorter + 1) / (tree.tokens + tree.kinds + 1) if length == 1 else shorter
        share = successors[context]
        estimate = (n - 1 + share * p) / (total[context] - 1 + share)
        return [n * np.log(estimate / p)]

    (gain,) = _by_context(pairs, size, left_out, ("gain",))
    tree.total.append(total)
    tree.successors.append(successors)
    tree.kept.append((total > 0) & (gain >= least_gain * total))


# 5. All of it.


def _scored(blocks: DataFrame, tree: Tree) -> DataFrame:
    """One row for each part of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            block = _Block(row, tree)
            for _ in block.walk():
                pass
            part, codes, parts = block.part[block.scored], block.codes[block.scored], len(row["keys"])
            base = np.log10((block.counts + 1) / (tree.tokens + tree.kinds + 1))[codes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["keys"], pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                 pa.array(np.bincount(part, minlength=parts)),
                 pa.array(np.bincount(part, weights=block.counts[codes] > 0, minlength=parts).astype(np.int64)),
                 pa.array(np.bincount(part, weights=base, minlength=parts)),
                 pa.array(np.bincount(part, weights=np.log10(block.probability[block.scored]), minlength=parts))],
                ["key", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    schema = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    return map_batches(blocks, run, schema)


def score(
    docs: DataFrame,
    folds: int = 7,
    held_out: int = 2,
    depth: int = DEPTH,
    p_min: float = P_MIN,
    least_count: int = LEAST_COUNT,
    least_gain: float = LEAST_GAIN,
    block_tokens: int = BLOCK_TOKENS,
    bucket_pairs: int = BUCKET_PAIRS,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs`` (doc_id, text).

    Held out are the texts whose id, as text, has a CRC-32 with the remainder ``held_out`` by ``folds``.
    ``base_score`` is the score of the root alone.
    """
    stage = Stage(docs.sparkSession, "suffix-tree")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    texts = id_and_text(docs).withColumn("held", fold == held_out)
    blocks = stage.save(_blocks(texts, depth, block_tokens), "blocks")
    # No block asks for more different words or pairs than it has tokens.
    buckets = 1 + (blocks.agg(F.sum("size")).first()[0] or 0) // bucket_pairs

    counted = stage.save(_counted_words(_asked_words(blocks, buckets), buckets), "counted-0")
    tokens, kinds = _totals(counted)
    least = max(least_count, int(np.ceil(p_min * tokens)))
    end = [_unpacked(r["data"], "<i8")[0][0] for r in counted.filter("kind = 'end'").collect()]  # one row
    tree = Tree(tokens, kinds, int(end[0]) if end else -1, _common(counted, least))
    known = blocks.select("block", "codes", *_TEXT_COLUMNS).join(_answers(counted, buckets).withColumnRenamed("answers", "known"), "block")
    known = stage.save(known, "known")
    stage.free("blocks", "counted-0")

    answers: list[DataFrame] = []
    for length in range(1, depth + 1):
        if not tree.size(length):
            break
        asked = _asked(_with_answers(known, answers), tree, length, buckets)
        counted = stage.save(_counted(asked, buckets, least), f"counted-{length}")
        _test(tree, counted.filter("kind = 'pairs'"), length, least_gain)
        if length < depth:
            context, successor = _frequent(counted)
            inner = successor != tree.end
            tree.grow(context[inner], successor[inner], length)
        answers.append(stage.save(_answers(counted, buckets), f"answers-{length}"))
        stage.free(f"counted-{length}")

    parts = _scored(_with_answers(known, answers), tree)
    whole = stage.save(
        parts.groupBy("key").agg(
            F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
        ),
        "scored",
    )
    stage.free("known", *[f"answers-{n}" for n in range(1, len(answers) + 1)])
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )

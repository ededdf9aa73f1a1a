"""Conversations as a prefix tree: turns that several of them begin with are emitted once.

A turn is formatted as ``<turn:role>text</turn>``. Inside roles and texts ``\\`` becomes ``\\\\``,
``<`` becomes ``\\l`` and ``>`` becomes ``\\g``, so no marker can occur there and the change can
be undone. The loss mask covers the (escaped) texts of assistant turns, without markers.

A node is a turn together with all turns before it, named by a 128-bit hash of that prefix. The
turns of a conversation are streamed in order through one task, which hands the hash, the depth
and the position on from batch to batch; nothing gathers a conversation or the way to a node.

A node belongs to the first of the conversations (by id as text) it occurs in. The nodes of one
conversation are a chain: an unbroken end of its way, on which the chains of others begin. The
way of a conversation is a list of a few stretches of chains, at most as long as its turns. In
the depth-first order of the tree each chain comes before those that begin on it, and those that
begin deeper come first. So the chains are sorted by ranges, a tree of any size is spread over
tasks, and the nodes of a chain follow each other. The output stream is the nodes' segments in
this order. Every node carries

``parent, depth, chain``  the node before it (null at the first turn), and how to find it by its place
``path``       its own key after those of its ancestors down from the last depth divisible by ``RUN``
``at``         its place in the stream, ``length`` characters long
``position``   the position id of its first character: the length of all its ancestors
``attention``  the stretches of the stream that it may attend to: those of the chains on its way
               and the begin of its own up to itself, neighbouring stretches joined
``mask_at, mask_length``  the part of the segment under the loss mask (length 0: none)

Places and positions are counted in characters (code points).

* null text or role counts as empty; rows are ordered by turn (null first), then role, then text
* rows with a null conv_id are one conversation; repeated rows are turns of their own
* equal conversations share their last node; other columns are ignored; no rows give no nodes
* the rows grow with the turns; a node's attention has at most one stretch for each chain on its way
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from galley.llm.common import Stage, map_batches, splittable

ASSISTANT = "assistant"
_END = "</turn>"
_ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_TURN = re.compile(r"<turn:([^<>]*)>([^<>]*)</turn>")
_TURNS = (
    "conv_id long, depth int, key binary, parent binary, path array<binary>, role string, segment string, "
    "length long, position long, mask_at long, mask_length long"
)
RUN = 16  # turns
_HEAVY = ["parent", "path", "role", "segment", "mask_at", "mask_length"]


def escape(text: str) -> str:
    return re.sub(r"[\\<>]", lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"\\": "\\", "l": "<", "g": ">"}[m[1]], text, flags=re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _turns(rows: DataFrame) -> DataFrame:
    """One row per turn of every conversation, with the node it is an occurrence of."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    whole = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    whole = whole.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    names = [f.split()[0] for f in _TURNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.string(), pa.string(), *[pa.int64()] * 4]
        own: object = run  # no conversation
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                out = []
                for conv_id, role, text in zip(*(batch.column(i).slice(at, 1024).to_pylist() for i in range(3))):
                    if conv_id != own:
                        own, key, depth, position = conv_id, None, 0, 0
                    head, body = f"<turn:{escape(role)}>", escape(text)
                    segment = head + body + _END
                    parent, key = key, hashlib.blake2b((key or b"") + segment.encode(), digest_size=16).digest()
                    path = [*path, key] if depth % RUN else [key]
                    masked = len(body) if role == ASSISTANT else 0
                    out.append((conv_id, depth, key, parent, path, role, segment, len(segment), position, len(head), masked))
                    depth, position = depth + 1, position + len(segment)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return map_batches(whole, run, _TURNS)


def write(conversations: DataFrame, path: str) -> None:
    """Write the tree of ``conversations`` (conv_id, turn, role, text) under ``path``.

    ``nodes``: the stream, one row per node; ``ends``: ``conv_id, key, n_turns, way``, the last
    node of every conversation and the stretches of chains that lead to it.
    """
    stage = Stage(conversations.sparkSession, "chat")
    turns = stage.save(_turns(conversations), "turns")
    turns = turns.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    owners = turns.groupBy("key").agg(F.min("conv").alias("chain"))
    # Every turn with the chain its node is in; what makes up a node, once for each.
    mine = F.col("conv") == F.col("chain")
    owned = turns.join(splittable(owners), "key").select(
        "conv", "chain", "key", "depth", "position", "length", *[F.when(mine, F.col(c)).alias(c) for c in _HEAVY]
    )
    owned = stage.save(owned, "owned")
    stage.free("turns")

    spans = owned.groupBy("conv", "chain").agg(
        F.min("depth").alias("first"), F.max("depth").alias("last"), F.min("position").alias("since"),
        F.max(F.col("position") + F.col("length")).alias("until"), F.max(F.struct("depth", "key")).alias("end"),
    )
    ways = spans.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("first", "last", "chain", "since", "until"))).alias("way"), F.max("end").alias("end")
    )
    ways = stage.save(ways, "ways")
    own = F.element_at("way", -1)
    chains = ways.filter(own["chain"] == F.col("conv")).select(
        "conv", "way", own["since"].alias("since"), (own["until"] - own["since"]).alias("size"),
        F.transform("way", lambda x: F.struct((-x["first"]).alias("up"), x["chain"].alias("chain"))).alias("order"),
    )
    ordered = chains.repartitionByRange("order").withColumn("part", F.spark_partition_id())
    ordered = stage.save(ordered.sortWithinPartitions("order"), "ordered")
    # Places in the stream: sums within a part, and over the parts (one row each).
    parts = ordered.groupBy("part").agg(F.sum("size").alias("all"))
    zero = F.lit(0).cast("long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("all").over(before), zero).alias("base"))
    within = Window.partitionBy("part").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    placed = ordered.join(parts, "part").withColumn("begin", F.col("base") + F.coalesce(F.sum("size").over(within), zero))
    placed = stage.save(placed.select("conv", "way", "since", "begin"), "placed")

    # The stretches on the way to the end of every chain; parents come before children in the stream.
    begins = placed.select(F.col("conv").alias("chain"), F.col("begin").alias("start"))
    stretch = F.struct("start", (F.col("start") + F.col("until") - F.col("since")).alias("end"))
    seen = placed.select("conv", F.explode("way").alias("w")).select("conv", "w.chain", "w.since", "w.until").join(begins, "chain")
    seen = seen.groupBy("conv").agg(F.array_sort(F.collect_list(stretch)).alias("s")).select(
        "conv",
        F.expr(
            """zip_with(filter(s, (x, i) -> coalesce(get(s, i - 1).end <> x.start, true)),
                 filter(s, (x, i) -> coalesce(get(s, i + 1).start <> x.end, true)),
                 (x, y) -> named_struct('start', x.start, 'end', y.end))"""
        ).alias("s"),
    )
    seen = stage.save(placed.select("conv", "since", "begin").join(seen, "conv"), "seen")
    nodes = owned.filter(mine).join(seen, "conv").withColumn("at", F.col("begin") + F.col("position") - F.col("since"))
    nodes = nodes.select(
        "key", "parent", "depth", "chain", "path", "role", "segment", "length", "position", "mask_at", "mask_length", "at",
        F.expr("concat(slice(s, 1, size(s) - 1), array(named_struct('start', element_at(s, -1).start, 'end', at + length)))").alias("attention"),
    )
    nodes.repartitionByRange("at").sortWithinPartitions("at").write.parquet(f"{path}/nodes")
    ends = ways.select(
        F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id"), F.col("end.key").alias("key"),
        (F.col("end.depth") + 1).cast("long").alias("n_turns"),
        F.transform("way", lambda x: F.struct(x["chain"].alias("chain"), x["first"].alias("first"), x["last"].alias("last"))).alias("way"),
    )
    ends.write.parquet(f"{path}/ends")
    stage.free()


def _ways(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The ends of the tree, and ``end, depth, segment, masked`` of the turns on the way to every different one."""
    nodes, ends = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/ends")
    steps = ends.dropDuplicates(["key"]).select(F.col("key").alias("end"), F.explode("way").alias("w"))
    steps = steps.select("end", F.col("w.chain").alias("chain"), F.explode(F.sequence("w.first", "w.last")).alias("depth"))
    masked = F.substring("segment", F.col("mask_at").cast("int") + 1, F.col("mask_length").cast("int"))
    way = steps.join(nodes.select("chain", "depth", "segment", masked.alias("masked")), ["chain", "depth"]).drop("chain")
    return ends.drop("way"), way


def read(spark: SparkSession, path: str) -> DataFrame:
    """``conv_id, n_turns, formatted, loss``: every conversation rebuilt from the tree, as one text each.

    ``formatted`` joins the segments on the way to its last node, ``loss`` what the mask covers.
    """
    ends, way = _ways(spark, path)
    built = way.groupBy("end").agg(F.array_sort(F.collect_list(F.struct("depth", "segment", "masked"))).alias("way"))
    built = built.select(F.col("end").alias("key"), F.array_join("way.segment", "").alias("formatted"), F.array_join("way.masked", "").alias("loss"))
    return ends.join(built, "key").select("conv_id", "n_turns", "formatted", "loss")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """``digest(read(spark, path))``, the turns streamed in order, so that no conversation is held as a whole."""
    ends, way = _ways(spark, path)
    way = way.select("end", "depth", "segment", "masked").repartition("end").sortWithinPartitions("end", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["key", "turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        pack = lambda out: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        own = None
        for batch in batches:
            out = []
            for end, segment, masked in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if end != own:
                    if own is not None:
                        out.append((own, turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars))
                    own, turns, loss_chars, chars, said, loss = end, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, text in parse(segment):
                    said.update(f"{role}\n{text}\n".encode())
                    turns += 1
                kept = unescape(masked)
                loss.update(kept.encode())
                loss_chars, chars = loss_chars + len(kept), chars + len(segment)
            if out:
                yield pack(out)
        if own is not None:
            yield pack([(own, turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars)])

    made = map_batches(way, run, "key binary, turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return ends.join(made, "key").select("conv_id", F.col("turns").alias("n_turns"), "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and hashes of conversations as ``read`` returns them; roles and texts are parsed and unescaped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv_id, formatted, masked in zip(*(batch.column(i).to_pylist() for i in range(3))):
                turns, loss = parse(formatted), unescape(masked)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return map_batches(
        conversations.select("conv_id", "formatted", "loss"), run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )

"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregation (combined before its shuffle) and one join, so a node with very
many links is split like any hot join key. Steps are written to the shared folder. The number
of steps grows with the logarithm of the longest chain.

* a link with a null end joins nothing: the null is a node of its own, without a component to share
* repeated links and self-links change nothing; no links give no rows
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from galley.llm.common import Stage, splittable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour to the smallest of its neighbourhood: the larger ones, or the others."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(splittable(smallest), "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.filter(F.col("b") < F.col("a"))
        smallest = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = (
            down.join(splittable(smallest), "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, stage: Stage, label: str) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); the component is its smallest node.

    Self-links only name a node. No edges give no rows.
    """
    nodes = stage.save(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{label}-nodes")
    links = stage.save(
        edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{label}-0",
    )
    state, step = _mark(links), 0
    while True:
        step += 1
        after = stage.save(_star(_star(links, True), False), f"{label}-{step}")
        stage.free(f"{label}-{step - 1}")
        links, last, state = after, state, _mark(after)
        if state == last:
            break
    labels = nodes.join(links.select(F.col("a").alias("node"), "b"), "node", "left")
    out = stage.save(labels.groupBy("node").agg(F.min(F.coalesce("b", "node")).alias("component")), f"{label}-out")
    stage.free(f"{label}-nodes", f"{label}-{step}")
    return out


def _mark(links: DataFrame) -> tuple:
    """Count and checksum of the links: two equal marks in a row mean that nothing moved."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

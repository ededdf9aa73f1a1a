"""Coverage of number ranges by intervals: what is missing, what is there more than once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from galley.operators.ranking import number_rows, running_sums


def _borders(intervals: DataFrame, group: Sequence[str], start: str, end: str, depth: int, frame: int) -> DataFrame:
    one = F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("sign")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("sign")))
    spread = intervals.filter(F.col(end) > F.col(start)).select(*group, F.explode(one).alias("border"))
    return spread.select(
        *group, F.col("border.at").cast("long").alias("at"),
        (F.col("border.sign") * F.lit(depth)).alias("depth"), (F.col("border.sign") * F.lit(frame)).alias("frame"),
    )


def coverage(
    intervals: DataFrame, frames: DataFrame, group: Sequence[str], start: str = "start", end: str = "end"
) -> DataFrame:
    """Maximal ranges ``first`` to ``until`` (exclusive) of each group that intervals do not cover exactly once.

    ``kind`` is ``missing`` (inside the group's frame, in no interval), ``repeated`` (in two
    intervals or more) or ``beyond`` (in one interval, outside the frame). ``intervals`` and
    ``frames`` hold the group's columns and half-open ranges; an empty range counts for nothing.

    A sweep: every border adds or takes one, equal borders are added up before they are
    shuffled, and running sums over range partitions give the depth on both sides of a border.
    Only borders at which the kind changes are kept; the k-th beginning of a kind belongs to
    its k-th end. No group passes through one task.
    """
    borders = _borders(intervals, group, start, end, 1, 0).unionByName(_borders(frames, group, start, end, 0, 1))
    borders = borders.groupBy(*group, "at").agg(F.sum("depth").alias("depth"), F.sum("frame").alias("frame"))
    borders = borders.filter((F.col("depth") != 0) | (F.col("frame") != 0))
    summed = running_sums(borders, ["at"], ["depth", "frame"], group)

    def kind(depth, frame):
        return (
            F.when(depth >= 2, "repeated").when((depth == 1) & (frame <= 0), "beyond").when((depth == 0) & (frame > 0), "missing")
        )

    after = kind(F.col("depth_sum"), F.col("frame_sum"))
    before = kind(F.col("depth_sum") - F.col("depth"), F.col("frame_sum") - F.col("frame"))
    changed = summed.select(*group, "at", before.alias("before"), after.alias("after")).filter(~F.col("before").eqNullSafe(F.col("after")))
    sides = {
        name: number_rows(
            changed.filter(F.col(side).isNotNull()).select(*group, F.col(side).alias("kind"), F.col("at").alias(name)), [name], [*group, "kind"], "n"
        )
        for side, name in (("after", "first"), ("before", "until"))
    }
    a, b = sides["first"].alias("a"), sides["until"].alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.kind") == F.col("b.kind"))
    for g in group:
        same = same & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return a.join(b, same).select(*[F.col(f"a.{g}").alias(g) for g in group], F.col("a.kind").alias("kind"), "first", "until")

"""Row numbers that do not funnel a table, or a hot group, through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from galley.operators.dedup import top_n_per_key
from galley.operators.joins import sized
from galley.session import materialize

# monotonically_increasing_id keeps the task number above this bit, the row position below.
_POSITION_BITS = 33


def _as_column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    group: Sequence[str] = (),
    name: str = "row_no",
) -> DataFrame:
    """Gap-free numbers from 1 under ``order_by``, restarting for every ``group``.

    The rows are range-partitioned by (group, order), so even one group holding everything
    is spread over all tasks. Each row keeps its position inside its task; a table of
    (task, group) run lengths, one row per task and group, says how many rows precede it.
    ``order_by`` must be a total order within the group.
    """
    keys = [*map(_as_column, group), *map(_as_column, order_by)]
    laid_out = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_task", F.shiftright("_pos", _POSITION_BITS))
    runs = laid_out.groupBy(*group, "_task").agg(F.min("_pos").alias("_start"), F.count("*").alias("_len"))
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_len").over(earlier), F.lit(0)))
    # Without groups there is one run per task, a bounded number; groups have to be measured.
    runs = sized(materialize(runs, "runs")) if group else F.broadcast(runs)
    same = F.col("l._task") == F.col("r._task")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    number = F.col("r._before") + F.col("l._pos") - F.col("r._start") + 1
    return (
        laid_out.alias("l")
        .join(runs.alias("r"), same)
        .select(*[F.col(f"l.`{c}`") for c in df.columns], number.alias(name))
    )


def running_sums(
    df: DataFrame, order_by: Sequence[str | Column], columns: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<column>_sum`` for each of ``columns``: the sum up to and with the row, in every ``group``.

    Range-partitioned like ``number_rows``: a window runs inside each task's stretch of a group,
    and a small table of stretch totals says what earlier tasks hold. ``order_by`` must be a
    total order within the group.
    """
    keys = [*map(_as_column, group), *map(_as_column, order_by)]
    laid_out = materialize(df.repartitionByRange(*keys).withColumn("_task", F.spark_partition_id()), "summed")
    stretch = Window.partitionBy(*group, "_task")
    totals = laid_out.groupBy(*group, "_task").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "_task", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in columns])
    totals = sized(materialize(totals, "totals"))
    inside = laid_out.select(
        "*", *[F.sum(c).over(stretch.orderBy(*map(_as_column, order_by)).rowsBetween(Window.unboundedPreceding, 0)).alias(f"{c}_sum") for c in columns]
    )
    same = F.col("l._task") == F.col("r._task")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}"))
    return inside.alias("l").join(totals.alias("r"), same).select(
        *[F.col(f"l.`{c}`") for c in df.columns], *[(F.col(f"l.{c}_sum") + F.col(f"r._{c}")).alias(f"{c}_sum") for c in columns]
    )


def parse_cap(value: int | str | None) -> int | None:
    """A cap argument: a whole number, or NULL / blank / all / todo / full for no cap.

    Any other text also means no cap.
    """
    if value is None or isinstance(value, bool):
        return None
    text = str(value).strip().lower()
    return int(text) if text.isdecimal() else None


def cap_per_group(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], n: int | str | None
) -> DataFrame:
    """The first ``n`` rows of every group under ``order_by``; no cap returns ``df``.

    A small cap is applied by every map task before the shuffle. Spark does that only up to
    ``windowGroupLimitThreshold``; a larger cap is numbered over range partitions instead,
    because a whole group would otherwise be sorted by one task.
    """
    n = parse_cap(n)
    if n is None:
        return df
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:
        return top_n_per_key(df, group, [*map(_as_column, order_by)], n)
    numbered = number_rows(df, order_by, group, "_n")
    return numbered.filter(F.col("_n") <= n).drop("_n")

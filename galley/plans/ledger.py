"""The run ledger: what each run reported, kept in a table, and gates that stop a run."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from galley.functions.literals import constant_rows
from galley.schemas import RUN_LOG
from galley.sources.tables import is_path, read_table, table_exists


class GateFailed(RuntimeError):
    """A run stopped by one of its checks; what it had done so far is in the ledger."""


def metrics(done: dict[str, object]) -> list[tuple[str, str, int]]:
    """``(phase, metric, value)`` of every number that the phases reported."""
    out: list[tuple[str, str, int]] = []

    def walk(phase: str, name: str, value: object) -> None:
        if isinstance(value, bool):
            out.append((phase, name, int(value)))
        elif isinstance(value, int):
            out.append((phase, name, value))
        elif isinstance(value, dict):
            for k, v in value.items():
                walk(phase, f"{name}.{k}" if name else str(k), v)
        elif dataclasses.is_dataclass(value):
            for f in dataclasses.fields(value):
                walk(phase, f"{name}.{f.name}" if name else f.name, getattr(value, f.name))

    for phase, value in done.items():
        walk(phase, "", value)
    return out


def record(
    spark: SparkSession,
    table: str,
    run_id: str,
    rows: Sequence[tuple[str, str, int]],
    status: str = "ok",
    at: dt.datetime | None = None,
) -> None:
    """Append the numbers of one run to the ledger. A few rows a run; nothing stored is rewritten."""
    stamp = at or dt.datetime.now(dt.timezone.utc)
    data = [(run_id, stamp, status, phase, metric, value) for phase, metric, value in rows] or [(run_id, stamp, status, None, None, None)]
    log = constant_rows(spark, data, RUN_LOG).coalesce(1)
    if is_path(table):
        log.write.mode("append").parquet(table)
    elif table_exists(spark, table):
        log.writeTo(table).append()
    else:
        log.writeTo(table).create()


def history(spark: SparkSession, table: str) -> DataFrame:
    """Every number of every run with that of the run before: ``previous`` and ``change``."""
    return with_previous(read_table(spark, table, RUN_LOG))


def with_previous(log: DataFrame) -> DataFrame:
    """The ledger's rows beside those of the run before, for each phase and metric."""
    runs = Window.partitionBy("phase", "metric").orderBy("run_at", "run_id")
    before = F.lag("value").over(runs)
    return log.filter(F.col("metric").isNotNull()).select(
        "run_id", "run_at", "status", "phase", "metric", "value", before.alias("previous"), (F.col("value") - before).alias("change")
    )

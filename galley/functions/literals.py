"""Frames made of literals. Spark knows their size, and no Python worker is started for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def empty_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, the given columns."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def constant_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A few rows given in the program text: topics, rules, expected counts."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not rows:
        return empty_rows(spark, schema)
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))

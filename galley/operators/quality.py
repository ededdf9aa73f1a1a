"""Normalisation, validation rules, quarantine, and row counts per layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from galley.functions.dates import parse_timestamp
from galley.functions.literals import constant_rows
from galley.functions.text import blank_to_null
from galley.operators.conform import union_all
from galley.operators.joins import join_dimension


def normalise(
    df: DataFrame, strings: tuple[str, ...] = (), timestamps: tuple[str, ...] = ()
) -> DataFrame:
    """Trim text (blank becomes NULL) and parse timestamp text (unparseable becomes NULL)."""
    changes = {c: blank_to_null(c) for c in strings}
    changes |= {c: parse_timestamp(blank_to_null(c)) for c in timestamps}
    return df.withColumns(changes)


def content_rules(
    types: tuple[str, ...], first_date, last_date
) -> dict[str, Column]:
    """Rule name to violation test for a content item; NULL tests count as passed."""
    return {
        "id_missing": F.col("id").isNull(),
        "type_unknown": F.col("content_type").isNull() | ~F.col("content_type").isin(*types),
        "title_blank": F.col("title").isNull() | (F.trim("title") == ""),
        "published_missing": F.col("published_at").isNull(),
        "published_out_of_range": (F.col("published_at") < F.lit(first_date))
        | (F.col("published_at") > F.lit(last_date)),
        "updated_before_published": F.col("updated_at") < F.col("published_at"),
    }


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with its violation count and the rows checked, in a single scan."""
    counts = df.agg(
        F.count("*").alias("checked"),
        *[F.count_if(test).alias(f"_{name}") for name, test in rules.items()],
    )
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"_{n}").alias("violations")) for n in rules]
    return counts.select(F.explode(F.array(*pairs)).alias("r"), "checked").select("r.rule", "r.violations", "checked")


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into rows that pass every rule and rows that fail, the latter naming the rules."""
    failed = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    marked = df.withColumn("failed_rules", failed)
    clean = marked.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return clean, marked.filter(F.size("failed_rules") > 0)


def schema_differences(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, surplus, or of another type than declared."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [
        (name, wanted.get(name), actual.get(name))
        for name in sorted(actual.keys() | wanted.keys())
        if actual.get(name) != wanted.get(name)
    ]
    return constant_rows(df.sparkSession, rows, "column string, expected string, actual string")


def unknown_sources(content: DataFrame, official: DataFrame, column: str = "news_site") -> DataFrame:
    """Items whose source is named but absent from the official list."""
    listed = official.select(column).filter(F.col(column).isNotNull()).distinct()
    return join_dimension(content.filter(F.col(column).isNotNull()), listed, column, "left_anti")


def layer_counts(layers: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows per (layer, entity), each counted where it lies."""
    return union_all(
        [
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), "row_count"
            )
            for (layer, entity), df in layers.items()
        ]
    )


def below_minimum(counts: DataFrame, minimum: dict[tuple[str, str], int]) -> DataFrame:
    """Layers that fall short of the least acceptable number; one that is absent counts 0."""
    rows = [(layer, entity, n) for (layer, entity), n in minimum.items()]
    least = constant_rows(counts.sparkSession, rows, "layer string, entity string, min_count long")
    found = least.join(counts, ["layer", "entity"], "left")
    found = found.select("layer", "entity", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"), "min_count")
    return found.filter(F.col("row_count") < F.col("min_count"))

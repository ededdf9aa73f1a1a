"""From raw documents to packed training sequences, in five stages over the whole corpus.

Each stage takes the documents that the one before it left, as a table, and works on all of
them: quality rules, near-duplicates, repeated passages, benchmark decontamination, packing.
A stage's table is deleted when the next one has been written.

* null text: no words, so the quality stage rejects it; empty texts likewise
* null ids: such rows are kept and take part everywhere; among near copies a row with an id stays
* repeated rows: one of them stays
* very long texts: worked on as a whole by every stage; ties go to the smaller id
* other columns are kept up to the last stage, whatever their names; an empty table gives no rows
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from galley.llm import containment, decision_list, packing, suffix_dedup, super_minhash
from galley.llm.common import table
from galley.session import scratch_path
from galley.sources import files

END_ID = 1  # appended to every document
CAPACITY = 4096  # tokens of a sequence
PASSAGE_WORDS = 50  # passages of this many words and more that repeat are cut out
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    return decision_list.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return super_minhash.one_of_each(docs, SHINGLE_WORDS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once."""
    return suffix_dedup.cleaned(docs, PASSAGE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return containment.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document in a packed sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Learned rules, signatures and tokens are beyond SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            files.delete(spark, before)
        before = path
    return docs

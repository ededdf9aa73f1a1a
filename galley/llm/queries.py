"""The operators on the supplied tables with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from galley.llm import (
    bpe_count,
    chat_tree,
    containment,
    decision_list,
    fill_middle,
    host_text,
    importance,
    packing,
    suffix_dedup,
    suffix_tree,
    super_minhash,
    token_store,
    two_pass_shuffle,
)
from galley.llm.common import table
from galley.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op7_bpe_heap_counts")
def bpe_heap_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document; over the limit are those with more than 1024."""
    counts = bpe_count.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


END_ID = 1  # appended to every document


@query("op2_elias_fano_store")
def elias_fano_store(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as binary token blocks, read back from the files."""
    path = scratch_path(spark, "token-store")
    token_store.write(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return token_store.read(spark, path)


@query("op6_two_pass_shuffle")
def two_pass(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in random order in 24 shards, read back from the files."""
    path = scratch_path(spark, "shuffled")
    two_pass_shuffle.write_shuffled(table(spark, folder, "documents"), path, shards=24)
    written = spark.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
    return two_pass_shuffle.digest(written)


@query("op10_dominance_packing")
def dominance_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID, 4096)


@query("op4_super_minhash")
def near_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles are similar to 0.8 or more."""
    return super_minhash.near_duplicates(table(spark, folder, "documents"), k=2).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query("op8_decision_list")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under the base rule and the rules learned from the labels."""
    return decision_list.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(
    "op9_containment_minhash",
    r"""
    WITH d AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
         b AS (SELECT item_id AS id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
         dw AS (SELECT id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
         bw AS (SELECT id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM b),
         dr AS (SELECT id, n, i, concat_ws(' ', x, lead(x) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS s
                FROM dw WINDOW o AS (PARTITION BY id ORDER BY i)),
         br AS (SELECT id, n, i, concat_ws(' ', x, lead(x) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS s
                FROM bw WINDOW o AS (PARTITION BY id ORDER BY i)),
         ds AS (SELECT DISTINCT id AS doc_id, s FROM dr WHERE i <= greatest(n - 4, 1)),
         bs AS (SELECT DISTINCT id AS item_id, s FROM br WHERE i <= greatest(n - 4, 1)),
         n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
    SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
    FROM ds JOIN bs USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= 80 * n_shingles
    """,
)
def contained_items(spark: SparkSession, folder: str) -> DataFrame:
    """Every test item that a document contains to 80 % or more."""
    found = containment.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared")


@query("op1_suffix_dedup")
def suffix_dedup_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes that a repeated 400-byte string covers."""
    return suffix_dedup.digest(suffix_dedup.without_repeats(table(spark, folder, "documents"), 400))


@query("op3_prefix_tree")
def prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, read back from the tree."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    path = scratch_path(spark, "chat-tree")
    chat_tree.write(rows, path)
    return chat_tree.read_digest(spark, path)


@query("op5_host_runs")
def page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return host_text.main_text(table(spark, folder, "pages"))


@query(
    "op11_importance_resampling",
    # DuckDB has no CRC-32: it is linear, so a word's is the XOR of what each byte comes to at its distance from the end.
    r"""
    WITH RECURSIVE bits AS (
           SELECT range AS b, 0 AS k, range AS v FROM range(256)
           UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
         byte_crc AS (SELECT b, v FROM bits WHERE k = 8),
         tokens AS (
           SELECT 'd' AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
           UNION ALL
           SELECT 't', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
         words AS (SELECT word, octet_length(encode(word)) AS n, hex(encode(word)) AS digits FROM (SELECT DISTINCT word FROM tokens)),
         placed AS (
           SELECT d.d AS d, b, v FROM byte_crc, (SELECT 0 AS d) d
           UNION ALL
           SELECT p.d + 1, p.b, xor(c.v, p.v >> 8) FROM placed p JOIN byte_crc c ON c.b = p.v & 255 WHERE p.d + 1 < (SELECT max(n) FROM words)),
         ones AS (
           SELECT 0 AS d, 4294967295 AS v
           UNION ALL
           SELECT o.d + 1, xor(c.v, o.v >> 8) FROM ones o JOIN byte_crc c ON c.b = o.v & 255 WHERE o.d < (SELECT max(n) FROM words)),
         bytes AS (
           SELECT word, n, n - i AS d, CAST('0x' || substr(digits, 2 * i - 1, 2) AS BIGINT) AS b
           FROM (SELECT word, n, digits, unnest(range(1, n + 1)) AS i FROM words)),
         crcs AS (
           SELECT word, xor(xor(any_value(ones.v), bit_xor(placed.v)), 4294967295) % 10000 AS bucket
           FROM bytes JOIN placed ON placed.d = bytes.d AND placed.b = bytes.b JOIN ones ON ones.d = bytes.n GROUP BY word),
         counts AS (
           SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM tokens JOIN crcs USING (word) GROUP BY bucket),
         gain AS (
           SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * ((SELECT sum(s) FROM counts) + 10000)
                  / ((CAST(s AS DOUBLE) + 1) * ((SELECT sum(t) FROM counts) + 10000)))) AS BIGINT) AS g FROM counts),
         found AS (
           SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS w FROM tokens JOIN crcs USING (word) JOIN gain USING (bucket)
           WHERE side = 'd' GROUP BY doc_id),
         scored AS (
           SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
                  coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                  / 4294967296))) AS BIGINT) AS score
           FROM documents LEFT JOIN found USING (doc_id)),
         ranked AS (
           SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
    SELECT scored.doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
    """,
)
def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn towards the benchmark's words: one in ten of those with 20 words and more."""
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query(
    "op12_fenwick_fim",
    r"""
    WITH d AS (
           SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
                  sha256('1:' || doc_id) AS h FROM documents),
         drawn AS (
           SELECT doc_id, text, w, len(w) AS n,
                  CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS y,
                  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                            OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
                       WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
         parts AS (
           SELECT doc_id, text, n, form, array_to_string(w[1:least(x, y)], '') AS p,
                  array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(w[greatest(x, y) + 1:], '') AS s FROM drawn)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
    FROM parts
    """,
)
def fenwick_fim(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle moved to the end, and its text rebuilt from that."""
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


@query("op13_suffix_tree_scores")
def suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under the words alone and under the suffix tree learned from six sevenths of them."""
    return suffix_tree.score(table(spark, folder, "documents"))

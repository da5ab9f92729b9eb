"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm import chat, decontamination, exact_dedup, langid, license_scan, line_dedup, packing, secret_scan, simhash, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path())


def op6_lsm_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.resolve(_read(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op2_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", F.sha2("candidate", 256).alias("candidate_sha256"), "chance", "is_secret")


def op3_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.hits(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("spans")


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), bw AS (
    SELECT item_id, k, array_to_string(w[i + 1 : i + k], ' ') AS win
    FROM (SELECT item_id, w, k, unnest(range(len(w) - k + 1)) AS i
          FROM (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0))
), ks AS (SELECT DISTINCT k FROM bw), dw AS (
    SELECT doc_id, k, i, array_to_string(w[i + 1 : i + k], ' ') AS win
    FROM (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) AS i FROM d JOIN ks ON len(w) >= k)
), hit AS (SELECT doc_id, k, i, item_id FROM dw JOIN bw USING (k, win)), words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_winnowing_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "removed", F.char_length("text").cast("long").alias("kept_chars"), kept.alias("kept_sha256"))


OP6_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""


def op7_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op8_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_read(spark, sf_dir, "conversations"))


OP8_SQL = r"""
WITH t AS (
    SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
    FROM conversations
), p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'), q AS (
    SELECT conv_id, perspective, plain || CASE WHEN k > 1 THEN '.' || k ELSE '' END AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, plain ORDER BY perspective) AS k
          FROM (SELECT *, regexp_replace(perspective, '[^A-Za-z0-9_-]', '_', 'g') AS plain FROM p))
), r AS (
    SELECT t.*, p.perspective,
           CASE WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
                WHEN role = p.perspective THEN '<|im_start|>assistant' || chr(10)
                ELSE '<|im_start|>user name=' || name || chr(10) END AS head
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
    LEFT JOIN q ON t.conv_id IS NOT DISTINCT FROM q.conv_id AND t.role = q.perspective
), s AS (SELECT *, head || replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS segment FROM r)
SELECT conv_id, perspective, row_number() OVER w - 1 AS n, turn,
       CAST(sum(length(segment)) OVER w AS BIGINT) - length(segment) AS start, segment,
       CAST(role = perspective AS INTEGER) AS mask, CAST(length(head) AS INTEGER) AS learn_from
FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
"""


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_read(spark, sf_dir, "documents"))


def op10_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_min_slack_packing": op1_min_slack_packing,
    "op2_forest_secret_scan": op2_forest_secret_scan,
    "op3_license_compression": op3_license_compression,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_winnowing_line_dedup": op5_winnowing_line_dedup,
    "op6_lsm_exact_dedup": op6_lsm_exact_dedup,
    "op7_rank_order_language": op7_rank_order_language,
    "op8_perspective_rotation": op8_perspective_rotation,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_mil_toxicity": op10_mil_toxicity,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": OP4_SQL,
    "op6_lsm_exact_dedup": OP6_SQL,
    "op8_perspective_rotation": OP8_SQL,
}

"""A corpus through five of the operators: each stage works on what the one before kept.

Toxic documents go (score of THRESHOLD or more), then all but one of equal texts, then all but one of each near-copy class, then
benchmark passages (and documents of which more than half is one); what is left is packed.

Odd rows: a null text counts as empty.  Empty texts score 0 and stay in the first stage, equal ones are copies of each other, and all
texts without words share one fingerprint, so one row of them is packed, as its end id.  Rows of one id and text count as
copies, and one stays; other texts of the same id, or of a null id, are documents of their own (of a near-copy class of one id, the
text with the least hash stays).  Ties go to the smallest doc_id, null last.  Columns beside doc_id and text come
along unread, whatever their names, up to packing; ``n_chars`` follows the text.  An empty table gives no pieces.
Each stage's result is written, and given up when the next one is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lineflow.llm import decontamination, exact_dedup, packing, simhash, toxicity
from lineflow.llm.queries import tokenizer_path
from lineflow.llm.shared import remove, scratch


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", remove_benchmark),
    ("packing", pack),
]

#: SQL can express neither the learned scores nor the packing: tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs

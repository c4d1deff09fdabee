"""Corpus pipeline: quality rules, near-dedup, decontamination, secret scan, byte-level BPE.

Defined cases of every stage: an empty table gives an empty result; columns beyond those of ``documents`` are left
out; very long texts are worked on whole.  Null and empty texts fail the quality rules; the later stages keep them
as clean and unlinked.  Rows without an id, or with the id of others, are judged each by its own text.  Of exact
copies near-dedup keeps the row of smallest id, and of equal ids the first as read; the other stages treat repeated rows alike.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import byte_bpe, decontamination, near_dedup, quality_rules, secrets
from cadastra.llm.common import bounded_batches, delete, read, shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.apply_rules(docs).where("kept").select(*COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of smallest id; documents without an id are judged like others."""
    return near_dedup.near_duplicates(docs).where("is_first").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontamination.mark(docs, read(spark, sf_dir, "benchmark")).where(F.size("hit_at") == 0).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars is that of the masked text."""
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    import public_tokenizers

    bounded_batches(spark)
    use = byte_bpe.tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = docs.withColumn("ids", byte_bpe.encode(F.col("text"), use))
    return ids.select(*COLUMNS, "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality rules", quality),
    ("near-dedup", dedup),
    ("decontamination", decontaminate),
    ("secret scan", mask_secrets),
    ("byte-level BPE", tokenize),
]

#: The near-duplicate components and the token ids have no SQL form that ends in reasonable time.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; only the last table stays."""
    top = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
        if k:
            delete(spark, f"{top}/{k - 1}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

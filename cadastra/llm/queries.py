"""Thin contract queries over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, decontamination, html_text, licenses, near_dedup, oracle, pii, quality_classifier, quality_rules, secrets
from .common import bounded_batches, read


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE_RULES]
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of = lambda *kinds: F.filter("secrets", lambda x: x["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    at, labels = F.transform("places", lambda p: p["at"]), F.array_distinct(F.transform("places", lambda p: p["label"]))
    joined = lambda xs: F.array_join(F.sort_array(xs), ",")
    score = F.greatest(F.when(F.size("places") > 0, licenses.SCORE_BASE).otherwise(0.0), F.col("detected.score"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        joined(labels).alias("base_labels"),
        joined(F.array_union(labels, F.col("detected.labels"))).alias("labels"),
        score.alias("score"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.mark(docs, read(spark, sf_dir, "benchmark"))
    n = F.size("hit_at").cast("bigint")
    return found.select(
        "doc_id",
        "n_words",
        n.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    pages = read(spark, sf_dir, "pages").select("page_id", "url", html_text.main_text(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_conversations(rows)
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    bounded_batches(spark)
    use = byte_bpe.tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = read(spark, sf_dir, "documents").select("doc_id", byte_bpe.encode(F.col("text"), use).alias("ids"))
    return docs.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(byte_bpe.little_endian(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), use), 256).alias("decoded_sha256"),
    )


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("is_first").alias("kept"))


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), key="cadastra")
    return done.select("doc_id", "n_values", "text")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(F.col("quality").isNotNull() & (fold != 0)).select("doc_id", "quality")
    model = quality_classifier.train(docs.where(fold != 0), labels)
    scored = docs.select("doc_id", (fold == 0).alias("held_out"), quality_classifier.score(F.col("text"), docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)

"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    html_text,
    language,
    language_model,
    materialise,
    negatives,
    packing,
    sharding,
    simhash,
    sketches,
    token_files,
    toxicity,
    whitening,
)
from .common import FOLDS, held_out, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), model.score(docs["text"]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.learn(docs).predict(docs["text"])
    scored = docs.select("doc_id", held_out().alias("held_out"), found.alias("found"))
    return scored.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontamination.digest(F.col("items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_tokens(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", crc)
    return sharding.shard_by_bytes(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise.training_order(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_versions(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 1
    docs = docs.withColumn("held_out", apart)
    model = language_model.fit(docs.where(~apart).select("text"))
    return model.score(docs).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_language, op3_best_fit_packing, op4_decontamination, op5_token_counts,
    op6_sharding, op7_simhash, op8_training_order, op9_fingerprints, op10_html,
    op11_whitening, op12_hard_negatives, op13_language_model,
)}
ORACLE: dict[str, str] = {}

"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemarts.llm.decontaminate import contamination
from lakemarts.llm.divergence import source_divergence
from lakemarts.llm.embedding_dedup import near_vectors
from lakemarts.llm.frames import table
from lakemarts.llm.language_id import documents_with_language, pages_with_language
from lakemarts.llm.language_model import held_out as held_out_of_model
from lakemarts.llm.language_model import score_texts, train_language_model
from lakemarts.llm.line_dedup import without_repeated_lines
from lakemarts.llm.merkle import hashed, manifest, tampered
from lakemarts.llm.near_dedup import near_duplicates
from lakemarts.llm.packing import pack
from lakemarts.llm.passages import repeated_passages
from lakemarts.llm.secrets import find_secrets, joined
from lakemarts.llm.token_counts import section_token_counts
from lakemarts.llm.toxicity import held_out, score_toxicity, train_toxicity


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        "contaminated",
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeated_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select(
        "doc_id",
        F.length(text).cast("bigint").alias("n_chars_left"),
        F.sha2(text, 256).alias("text_sha256"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "component_id", "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_token_counts(table(spark, sf_dir, "documents"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("start").alias("start_word"),
        F.col("end").alias("end_word"),
        F.col("doc_id0").alias("source_doc_id"),
        F.col("start0").alias("source_start_word"),
        F.col("end0").alias("source_end_word"),
        F.round("identity", 6).alias("identity"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda one: one["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(name)
        for kind, name in enumerate(("n_assign", "n_access", "n_hex"))
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_with_language(table(spark, sf_dir, "documents")).drop("text_hash")


def page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_with_language(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train_toxicity(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    proven = manifest(docs, changed={"text": tampered(docs["doc_id"], docs["text"])})
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        hashed(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out_of_model(F.col("doc_id"))
    model = train_language_model(docs.filter(~out).select("text"))
    scored = score_texts(docs, model)
    return scored.select(
        "doc_id",
        out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


LLM_QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_passages": op7_passages,
    "op8_secrets": op8_secrets,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_source_divergence": op11_source_divergence,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language_model": op13_language_model,
    "page_language": page_language,
}

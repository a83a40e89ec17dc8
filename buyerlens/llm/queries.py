"""The registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerlens.llm import (
    bpe,
    collocations,
    decontam,
    divergence,
    lm,
    packing,
    pii,
    quality,
    simhash,
    token_counts,
    topk,
    toxicity,
    warc,
)
from buyerlens.llm.common import fold, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return rows.select(
        "doc_id",
        *[count(k) for k in pii.BASE_KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_documents(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.token_files(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = fold("doc_id", 3) != 1
    labels = table(spark, sf_dir, "labels").filter(learn)
    scored = toxicity.score_documents(table(spark, sf_dir, "documents"), labels, learn)
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.array_join("spans", ",").alias("offending"),
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.with_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = bpe.with_text(rows.drop("text"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = fold("doc_id", 5) != 0
    labels = table(spark, sf_dir, "labels").filter(learn)
    scored = quality.score_documents(table(spark, sf_dir, "documents"), labels, learn)
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archived(table(spark, sf_dir, "pages"))
    return rows.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_lm": op5_lm,
    "op6_token_files": op6_token_files,
    "op7_toxicity": op7_toxicity,
    "op8_top_k": op8_top_k,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_divergence": op11_divergence,
    "op12_warc": op12_warc,
    "op13_collocations": op13_collocations,
}

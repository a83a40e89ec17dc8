"""From raw documents to token ids in five stages.

Each stage takes the rows its predecessor kept, as Parquet, and its decisions take effect: rejected, copied
and contaminated documents go, personal data are replaced in the texts, and the last stage adds token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerlens.llm import bpe, decontam, pii, quality, simhash
from buyerlens.llm.common import fold, new_path, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more; labels of four fifths of the ids are learned from."""
    learn = fold("doc_id", 5) != 0
    return quality.keep_good(docs, table(spark, sf_dir, "labels").filter(learn), learn, least=0.3)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles at most three bits apart connect."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontam.find_items(docs, table(spark, sf_dir, "benchmark"), keep_docs=True, unnamed=True)
    return found.filter("n_hit = 0").select("doc.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by the kind; n_chars follows the new text."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether the ids spell the text again."""
    rows = bpe.with_text(bpe.with_ids(docs))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.withColumns({"n_tokens": F.size("ids").cast("long"), "round_trip": same}).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("simhash near-dedup", without_copies),
    ("benchmark decontamination", without_benchmarks),
    ("personal data", without_personal_data),
    ("bpe encoding", as_tokens),
]

#: SQL cannot say the classifier, the fingerprints or the merges; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

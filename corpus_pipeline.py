"""From raw documents to packed sequences: each stage is one operator, written and read again by the next.

run(spark, sf_dir) gives the rows of the last stage. No stage can be told in SQL as a
whole, so ORACLE_SQL is None; tests/llm compares the stages with brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ranklab.llm import decontaminate, near_dup, packing, quality_knn, secret_scan
from ranklab.llm.queries import table, tokenizer
from ranklab.session import keep

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among `docs`, predicts to be good."""
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    return quality_knn.score(docs, model).where("predicted = 1").select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id."""
    return near_dup.first_of_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; n_chars follows where a text has changed."""
    spans = "spans"
    while spans in docs.columns:
        spans += "_"
    clean = secret_scan.redact(secret_scan.scan(docs, into=spans), spans=spans)
    n_chars = F.when(F.size(spans) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs

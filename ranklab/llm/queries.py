"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ranklab.llm import (decontaminate, html_text, licenses, near_dup, packing, piece_codec, prefix_trie, quality_knn,
                         quality_rules, secret_scan, toxicity, turn_repair, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer())


@query
def op6_benchmark_decontamination(spark, sf):
    return decontaminate.digest(decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark")))


@query
def op2_secret_scans(spark, sf):
    return secret_scan.digest(secret_scan.scan(table(spark, sf, "documents")))


@query
def op3_url_filters(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), url_filter.base_rules(spark))


@query
def op8_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"))


@query
def op5_html_extraction(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


@query
def op9_license_scans(spark, sf):
    return licenses.digest(licenses.scan(table(spark, sf, "documents")))


@query
def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


@query
def op10_quality_classifier(spark, sf):
    docs = table(spark, sf, "documents")
    scored = quality_knn.score(docs.select("doc_id", "text"), quality_knn.fit(docs, table(spark, sf, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op7_minhash_near_dedup(spark, sf):
    return near_dup.classes(table(spark, sf, "documents")).select("doc_id", "class_id", "first")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_sentencepiece_codec(spark, sf):
    model = piece_model()
    return piece_codec.digest(piece_codec.decode(piece_codec.encode(table(spark, sf, "documents"), model), model))


@query
def op12_conversation_prefix_trie(spark, sf):
    return prefix_trie.trie(table(spark, sf, "conversations"))


@query
def op13_conversation_repair(spark, sf):
    return turn_repair.digest(turn_repair.repair(turn_repair.damage(table(spark, sf, "conversations"))))

"""Bounded samples of labelled documents, for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HELD_OUT = 2     # of the four parts by crc32 of the id as text


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels are never learnt."""
    return F.pmod(F.crc32(F.col(doc_id) if isinstance(doc_id, str) else doc_id), F.lit(4)) == HELD_OUT


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(held_out(doc_id.cast("string").cast("binary")), F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(at, label, text): at most `rows` documents with a label that are not held out, chosen by a hash of their id.

    A document with several labels has their rounded mean. Ids that occur more than once in
    `docs` count with one of their texts (the smallest).
    """
    told = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("double").alias("label")).where(
        "doc_id is not null and label is not null").groupBy("doc_id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    chosen = told.where(~is_held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    own = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).where("text is not null")
    return own.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select(
        F.xxhash64("doc_id").alias("at"), "label", "text")     # at most `rows` rows; broadcast is bounded by that

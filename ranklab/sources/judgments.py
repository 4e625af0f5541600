"""Relevance judgments: `topic x document y`, blank separated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

QRELS_SCHEMA = "query_id BIGINT, iter BIGINT, doc_id BIGINT, rel BIGINT"


def read_qrels(spark: SparkSession, path: str, least_rel: int | None = None) -> DataFrame:
    """(query_id, doc_id): columns 0 and 2. A line that is no judgment is an error.

    The grade is ignored, so every line is a relevant document, unless `least_rel` is given:
    then only lines of that grade or more are.
    """
    rows = spark.read.schema(QRELS_SCHEMA).option("mode", "FAILFAST").csv(path, sep=" ")
    told = rows.select(*[F.coalesce(c, F.raise_error(F.lit(f"a judgment without {c}")).cast("bigint")).alias(c)
                         for c in ("query_id", "doc_id")], "rel")
    return (told if least_rel is None else told.where(F.col("rel") >= least_rel)).select("query_id", "doc_id")


def qrels_lines(qrels: DataFrame) -> DataFrame:
    return qrels.select(F.concat_ws(" ", F.col("query_id"), F.lit(0), F.col("doc_id"), F.lit(1)).alias("value"))

"""Score lists: one number per line, the last blank-separated part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ranklab.functions import text as tx


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): pos counts lines from 0 over the files in name order.

    Splits are numbered, not lines: each split reports its number of lines, a
    running sum over the (few) splits gives each its first position, and within
    a split the line order is the read order. A line whose last part is no number is an error.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value")
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("file", "start").rowsBetween(
        W.unboundedPreceding, -1)), F.lit(0))
    placed = splits.select("file", "start", "first", before.alias("offset"))
    return (lines.join(placed, ["file", "start"])
            .select((F.col("offset") + F.col("at") - F.col("first")).alias("pos"),
                    F.coalesce(tx.parse_double(tx.split_pick(F.col("value"), -1)), F.raise_error(F.concat(
                        F.lit("no number ends the line: "), F.col("value"))).cast("double")).alias("value")))

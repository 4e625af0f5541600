"""Paired tests of many pairs of runs in one job.

Input rows are (pair, query_id, a, b): any number of pairs, keyed by `pair`
columns. The t test is one aggregation with partial sums; the signed-rank test
needs the ranks of |a - b| and so one window per pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ranklab.functions import distributions as ds
from ranklab.session import keep

# Differences are rounded, so that 0.8 - 0.6 and 0.6 - 0.4 are the same rank.
DIFF_DIGITS = 9


def pair_samples(a: DataFrame, b: DataFrame, on: Sequence[str] = ("query_id",), strict: bool = False) -> DataFrame:
    """Pair two lists of values by key: topic ids, or the line position for files.

    `strict`: a value without a partner is an error, as it is for lists whose lines belong
    together. Otherwise `unpaired` counts what is left out.
    """
    one, two = a.withColumnRenamed("value", "a"), b.withColumnRenamed("value", "b")
    if not strict:
        return one.join(two, list(on)).where("a is not null and b is not null")
    both = one.join(two, list(on), "full")
    return both.select(*[c for c in both.columns if c not in ("a", "b")], *[
        F.coalesce(c, F.raise_error(F.lit(f"a pair of values without {c}")).cast("double")).alias(c) for c in ("a", "b")])


def unpaired(a: DataFrame, b: DataFrame, on: Sequence[str] = ("query_id",)) -> DataFrame:
    """One row (only_a, only_b): how many values have no partner."""
    one, two = a.where("value is not null").select(*on, F.lit(1).alias("a")), b.where("value is not null").select(*on, F.lit(1).alias("b"))
    return one.join(two, list(on), "full").agg(F.count_if(F.col("b").isNull()).alias("only_a"),
                                               F.count_if(F.col("a").isNull()).alias("only_b"))


def _differences(pairs: DataFrame, sign: int = 1) -> DataFrame:
    return pairs.withColumn("d", F.round(sign * (F.col("a") - F.col("b")), DIFF_DIGITS))


def paired_t(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n, df, t, p_t): two-sided; null when all differences are equal."""
    sums = _differences(pairs).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("d").alias("mean_d"), F.stddev_samp("d").alias("sd"))
    t = F.when(F.col("sd") > 1e-12, F.col("mean_d") / (F.col("sd") / F.sqrt(F.col("n").cast("double"))))
    rows = sums.select(*by, "n", (F.col("n") - 1).alias("df"), t.alias("t"))
    return rows.withColumn("p_t", ds.t_two_sided(F.col("t"), F.col("df")))


def reject(p: Column, alpha: float) -> Column:
    """True when p < alpha; null when there is no p."""
    if not 0.0 < alpha <= 0.5:
        raise ValueError("alpha must lie in (0, 0.5]")
    return p < F.lit(alpha)


def abs_diff_ranks(pairs: DataFrame, by: Sequence[str], zero_method: str = "keep") -> DataFrame:
    """Rows with d = b - a and avg_rank, the average rank of |d| within the pair.

    Ranks come from counts per distinct |d|: equal differences, zeros above all,
    are one row before any window runs.
    """
    if zero_method not in ("keep", "drop"):
        raise ValueError("zero_method is keep or drop")
    rows = _differences(pairs, -1).withColumn("size", F.abs("d"))
    if zero_method == "drop":
        rows = rows.where("size > 0")
    groups = _ranked_sizes(rows.groupBy(*by, "size").agg(F.count("*").alias("same")), by)
    return rows.join(groups.select(*by, "size", "avg_rank"), [*by, "size"]).drop("size")


def _ranked_sizes(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """`groups` (by..., size, same, ...) with avg_rank, the average rank of each size within its pair.

    Sizes are sorted over ranges, so that one pair may have any number of them: a rank is the
    count inside the range plus that of the pair's ranges before, one row per pair and range.
    """
    placed = keep(groups.repartitionByRange(*by, "size").withColumn("part", F.spark_partition_id()))
    before = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ranges = placed.groupBy(*by, "part").agg(F.sum("same").alias("here")).select(
        *by, "part", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    inside = W.partitionBy(*by, "part").orderBy("size").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = placed.withColumn("upto", F.sum("same").over(inside)).join(ranges, [*by, "part"])
    return ranked.withColumn("avg_rank", F.col("before") + F.col("upto") - (F.col("same") - 1) / 2).drop("before", "upto", "part")


def wilcoxon(pairs: DataFrame, by: Sequence[str], zero_method: str = "keep") -> DataFrame:
    """(by..., n, w_plus, w, z, p_w) of b - a: signed ranks, normal approximation with
    a correction of one half. Zeros that are kept count on the minus side."""
    rows = _differences(pairs, -1).withColumn("size", F.abs("d"))
    if zero_method not in ("keep", "drop"):
        raise ValueError("zero_method is keep or drop")
    if zero_method == "drop":
        rows = rows.where("size > 0")
    groups = rows.groupBy(*by, "size").agg(
        F.count("*").alias("same"), F.count_if(F.col("d") > 0).alias("plus"))
    sums = _ranked_sizes(groups, by).groupBy(*by).agg(
        F.sum("same").alias("n"), F.sum(F.col("plus") * F.col("avg_rank")).alias("w_plus"))
    n = F.col("n").cast("double")
    total = n * (n + 1) / 2
    w = F.greatest(F.col("w_plus"), total - F.col("w_plus"))
    z = ((total - F.col("w")) - total / 2 - 0.5) / F.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    rows = sums.withColumn("w", w).withColumn("z", z)
    # z lies below the mean by construction; the p-value doubles the lower tail, whose
    # probability is that of |z| as long as z <= 0, which the correction guarantees.
    return rows.select(*by, "n", "w_plus", "w", "z", ds.normal_two_sided(F.col("z")).alias("p_w"))


def paired_tests(pairs: DataFrame, by: Sequence[str], alpha: float, zero_method: str = "keep") -> DataFrame:
    """Both tests side by side, one row per pair of runs."""
    t = paired_t(pairs, by).withColumn("reject", reject(F.col("p_t"), alpha))
    return t.join(wilcoxon(pairs, by, zero_method).drop("n"), list(by))

"""Choose the smoothing weight on training topics, report it on held-out topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.operators import evaluate as ev, scoring as sc
from ranklab.operators.index import Index

# Metric values are compared after rounding: the last bit must not choose a lambda.
VALUE_DIGITS = 9


def grid_topics(topics: DataFrame, lams: Sequence[float] = sc.LAMBDAS) -> DataFrame:
    """(query_id, lam): every topic under every lambda, without a join."""
    return topics.select("query_id", F.explode(F.array(*[F.lit(x) for x in lams])).alias("lam"))


def grid_metrics(index: Index, topics: DataFrame, terms: sc.TopicTerms, qrels: DataFrame, cut: int,
                 metric: str = "MAP", lams: Sequence[float] = sc.LAMBDAS,
                 compat: Compat = STANDARD, ranked: DataFrame | None = None) -> DataFrame:
    """(query_id, lam, value): the metric of every cell of the grid. `ranked`: a stored run of it."""
    by = ("query_id", "lam")
    if ranked is None:
        ranked = sc.run_grid(index, terms, cut, lams, compat)
    judged = ev.judge(ranked.where(F.col("rank") <= cut), qrels)
    cells = ev.evaluate(judged, qrels, grid_topics(topics, lams), cut, by, keep_all(compat))
    return ev.select_metric(cells, metric, by)


def keep_all(compat: Compat) -> Compat:
    """In training, a topic without relevant hits stays, with value 0."""
    return Compat(**{**compat.__dict__, "drop_without_hits": False})


def grid_pivot(grid: DataFrame, lams: Sequence[float] = sc.LAMBDAS) -> DataFrame:
    """One row per topic, one column per lambda (l_0_1 ... l_1_0)."""
    cells = [F.max(F.when(F.col("lam") == x, F.col("value"))).alias("l_" + str(x).replace(".", "_"))
             for x in lams]
    return grid.groupBy("query_id").agg(*cells)


def lambda_means(grid: DataFrame, compat: Compat = STANDARD) -> DataFrame:
    """(lam, mean_value); in compat mode the sum over a fixed divisor."""
    mean = F.sum("value") / compat.grid_divisor if compat.grid_divisor else F.avg("value")
    return grid.groupBy("lam").agg(mean.alias("mean_value"))


def best_lambda(grid: DataFrame, compat: Compat = STANDARD) -> DataFrame:
    """One row (lam, value): best mean, smallest lambda on ties; in compat mode
    the first highest single cell in topic, then lambda order, or lambda 0 where all cells are 0."""
    if compat.best_single_cell:
        rows, order = grid.select("query_id", "lam", F.round("value", VALUE_DIGITS).alias("value")), ["query_id", "lam"]
    else:
        rows, order = lambda_means(grid).select(
            "lam", F.round("mean_value", VALUE_DIGITS).alias("value")), ["lam"]
    # A minimum over ordered structs keeps one row per task; nothing is sorted.
    first = F.min(F.struct((-F.col("value")).alias("lowest"), *order, "value"))
    best = rows.where("value is not null").agg(first.alias("best")).select("best.lam", "best.value")
    if compat.best_single_cell:
        best = best.withColumn("lam", F.when(F.col("value") > 0, F.col("lam")).otherwise(0.0))
    return best


def heldout(index: Index, topics: DataFrame, terms: sc.TopicTerms, qrels: DataFrame, cut: int,
            lam: Column | float, metric: str = "MAP", compat: Compat = STANDARD) -> DataFrame:
    """(query_id, value) of the held-out topics under one lambda, which may be a subquery."""
    ranked = sc.run(index, terms, cut, "jm", lam, compat)
    rows = ev.evaluate(ev.judge(ranked, qrels), qrels, topics.select("query_id"), cut, compat=keep_all(compat))
    return ev.select_metric(rows, metric)

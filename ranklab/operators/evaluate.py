"""Judge rankings and measure precision, recall and average precision at a cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.functions import text as tx

# Topic ids whose single-precision sum is taken in one piece.
TOPIC_RANGE = 1024
METRICS = ("p", "r", "ap")


def judgments(qrels: DataFrame, compat: Compat = STANDARD) -> DataFrame:
    pairs = qrels.select("query_id", "doc_id")
    return pairs.distinct() if compat.dedupe_judgments else pairs


def judged_counts(qrels: DataFrame) -> DataFrame:
    """(query_id, n_judged), by partial counts, however uneven the topics are."""
    return qrels.groupBy("query_id").agg(F.count("*").alias("n_judged"))


def judge(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Mark each hit: relevant 0/1. The key (topic, document) is even, so no side is hot."""
    marks = qrels.select("query_id", "doc_id", F.lit(1).alias("relevant"))
    return (run.join(marks, ["query_id", "doc_id"], "left")
            .withColumn("relevant", F.coalesce("relevant", F.lit(0))))


def relevant_retrieved(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """(query_id, doc_id): retrieved and judged relevant, each once."""
    keys = ["query_id", "doc_id"]
    return run.select(*keys).intersect(qrels.select(*keys))


def running_precision(judged: DataFrame, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """Add first_seen (a relevant document's best rank) and precision, the distinct
    relevant documents so far over the rank. A topic has at most `cut` rows here."""
    first = F.row_number().over(W.partitionBy(*by, "doc_id").orderBy("rank")) == 1
    seen = judged.withColumn("first_seen", F.when(first, F.col("relevant")).otherwise(0))
    upto = W.partitionBy(*by).orderBy("rank").rangeBetween(W.unboundedPreceding, W.currentRow)
    return seen.withColumn("precision", F.sum("first_seen").over(upto) / F.col("rank"))


def evaluate(judged: DataFrame, qrels: DataFrame, topics: DataFrame, cut: int,
             by: Sequence[str] = ("query_id",), compat: Compat = STANDARD) -> DataFrame:
    """(by..., n_rel, hits, n_judged, p, r, ap).

    `topics` lists the keys to report: a topic without any hit scores 0. Recall of
    a topic without judgments is null. `ap` is the sum of precisions at relevant
    ranks over the judgments, or, with `hits_over_cut`, distinct/cut added up once
    per relevant hit in single precision and divided by distinct.
    """
    sums = running_precision(judged, by).groupBy(*by).agg(
        F.sum("first_seen").alias("n_rel"), F.sum("relevant").alias("hits"),
        F.sum(F.when(F.col("first_seen") == 1, F.col("precision"))).alias("precisions"))
    rows = (topics.join(sums, list(by), "left")
            .join(judged_counts(qrels), "query_id", "left")
            .fillna(0, ["n_rel", "hits", "n_judged"]).fillna(0.0, ["precisions"]))
    judged_or_null = F.when(F.col("n_judged") > 0, F.col("n_judged"))
    p = F.col("n_rel") / F.lit(cut)
    if compat.hits_over_cut:
        added = tx.float32_sum(F.when(F.col("hits") > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.col("hits").cast("int"), F.lit(1))), lambda _: p)))
        ap = F.coalesce((added / F.col("n_rel").cast("float")).cast("float").cast("double"), F.lit(0.0))
    else:
        ap = F.coalesce(F.col("precisions") / judged_or_null, F.lit(0.0))
    out = rows.select(*by, "n_rel", "hits", "n_judged", p.alias("p"),
                      (F.col("n_rel") / judged_or_null).alias("r"), ap.alias("ap"))
    return topics_with_hits(out) if compat.drop_without_hits else out


def topics_with_hits(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("n_rel") > 0)


def metric_column(name: str) -> Column:
    """`P`, `R` or `MAP`; any other name gives 0 for every topic."""
    column = {"P": "p", "R": "r", "MAP": "ap"}.get(name)
    return F.col(column) if column else F.lit(0.0)


def select_metric(metrics: DataFrame, name: str, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """(by..., value) of the metric with that name."""
    return metrics.select(*by, metric_column(name).alias("value"))


def mean_metrics(metrics: DataFrame, n_topics: DataFrame, compat: Compat = STANDARD) -> DataFrame:
    """One row of means (mean_p, mean_r, mean_ap).

    `n_topics` holds the number of topics searched: in compat mode topics that
    left the report still count, three times each.
    """
    if compat.mean_divisor == 1:
        return metrics.agg(*[F.avg(m).alias(f"mean_{m}") for m in METRICS])
    # The original adds single-precision numbers topic by topic: so do we, within each range of TOPIC_RANGE ids.
    # The sums of the ranges are added up in double precision; a report of up to TOPIC_RANGE topics has its very digits.
    ranges = metrics.groupBy(F.floor(F.col("query_id") / TOPIC_RANGE).alias("range")).agg(
        *[tx.float32_sum(F.transform(F.array_sort(F.collect_list(F.struct("query_id", F.coalesce(m, F.lit(0.0)).alias("v")))),
                                     lambda x: x["v"])).alias(m) for m in METRICS])
    n = n_topics.agg(F.count("*").alias("n")).scalar() * compat.mean_divisor
    return ranges.agg(*[F.sum(F.col(m).cast("double")).alias(m) for m in METRICS]).select(
        *[(F.col(m).cast("float") / n.cast("float")).cast("float").cast("double").alias(f"mean_{m}") for m in METRICS])


def pooled_mean(metrics: DataFrame, n_topics: DataFrame) -> DataFrame:
    """All values of all metrics in one mean over 3 values per topic."""
    values = metrics.unpivot(["query_id"], list(METRICS), "metric", "value")
    n = n_topics.agg(F.count("*").alias("n")).scalar() * len(METRICS)
    return values.agg(F.sum("value").alias("s")).select((F.col("s") / n).alias("pooled_mean"))


def report_with_total(metrics: DataFrame) -> DataFrame:
    """Per-topic rows and one total row (is_total 1, query_id null) from one rollup."""
    return metrics.rollup("query_id").agg(
        F.grouping("query_id").cast("int").alias("is_total"),
        *[F.avg(m).alias(m) for m in METRICS])

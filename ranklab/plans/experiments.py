"""The four experiments, composed from the operators: index, search and evaluate,
train and test, compare. Each returns lazy DataFrames; writing is the caller's choice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.operators import evaluate as ev, scoring as sc, significance as sg, tune
from ranklab.operators.index import Index
from ranklab.session import keep
from ranklab.sinks import index_store as store, reports
from ranklab.sources.records import read_collection


def index_collection(spark: SparkSession, source: str, path: str, mode: str = "create",
                     compat: Compat = STANDARD) -> Index:
    """Read a tagged collection or a folder of document files and store its index."""
    store.write_index(read_collection(spark, source), path, mode, compat.lenient_names)
    return store.open_index(spark, path)


@dataclass(frozen=True)
class SearchResult:
    run: DataFrame
    matches: DataFrame
    metrics: DataFrame
    topics: DataFrame
    compat: Compat

    def means(self, metrics: DataFrame | None = None) -> DataFrame:
        return ev.mean_metrics(metrics or self.metrics, self.topics, self.compat)

    def ranking_lines(self, top: int, cut: int, number=reports.decimals) -> DataFrame:
        return reports.ranking_report(reports.query_texts(self.topics), self.matches,
                                      sc.display_top(self.run, top, cut), number)

    def metrics_lines(self, cut: int, number=reports.decimals) -> DataFrame:
        metrics = keep(self.metrics)
        return reports.metrics_csv(metrics, self.means(metrics), cut, number)


def search_and_evaluate(index: Index, topics: DataFrame, qrels: DataFrame, model: str = "tfidf",
                        lam: float = 0.5, cut: int = 10, compat: Compat = STANDARD,
                        terms: sc.TopicTerms | None = None, ranked: DataFrame | None = None) -> SearchResult:
    """All topics against all documents, then the metrics at `cut`. `ranked`: a stored run of that search."""
    if cut <= 0:
        raise ValueError("cut must be at least 1")
    terms = terms or sc.measure_terms(topics)
    ranked = sc.run(index, terms, cut, model, lam, compat) if ranked is None else ranked.where(F.col("rank") <= cut)
    judged_pairs = ev.judgments(qrels, compat)
    ids = topics.select("query_id")
    metrics = ev.evaluate(ev.judge(ranked, judged_pairs), judged_pairs, ids, cut, compat=compat)
    return SearchResult(ranked, sc.count_by_bitmaps(index, terms, compat.copies), metrics, topics, compat)


def evaluate_tfidf(index: Index, topics: DataFrame, qrels: DataFrame, cut: int, metric: str,
                   compat: Compat = STANDARD, terms: sc.TopicTerms | None = None,
                   ranked: DataFrame | None = None) -> DataFrame:
    """(query_id, value): one metric per topic under TF-IDF; topics without hits stay."""
    result = search_and_evaluate(index, topics, qrels, "tfidf", cut=cut,
                                 compat=tune.keep_all(compat), terms=terms, ranked=ranked)
    return ev.select_metric(result.metrics, metric)


@dataclass(frozen=True)
class TrainingResult:
    grid: DataFrame
    best: DataFrame
    heldout: DataFrame


def train_and_test(index: Index, train: DataFrame, test: DataFrame, qrels: DataFrame, cut: int,
                   metric: str = "MAP", compat: Compat = STANDARD,
                   train_terms: sc.TopicTerms | None = None,
                   test_terms: sc.TopicTerms | None = None, ranked: DataFrame | None = None) -> TrainingResult:
    """Jelinek-Mercer: the lambda chosen on one set of topics, reported on another.

    The chosen lambda reaches the held-out search as a subquery, not over the driver. `ranked`:
    a stored run of the training topics under all lambdas.
    """
    pairs = ev.judgments(qrels, compat)
    grid = keep(tune.grid_metrics(index, train, train_terms or sc.measure_terms(train), pairs, cut, metric,
                                  compat=compat, ranked=ranked))
    best = tune.best_lambda(grid, compat)
    values = tune.heldout(index, test, test_terms or sc.measure_terms(test), pairs, cut,
                          best.select("lam").scalar(), metric, compat)
    return TrainingResult(grid, best, values)


def compare(a: DataFrame, b: DataFrame, alpha: float, on: str = "pos", zero_method: str = "keep") -> DataFrame:
    """Both paired tests for two lists of (on, value); lists paired by position must be equally long."""
    pairs = sg.pair_samples(a, b, [on], strict=on == "pos").withColumn("pair", F.lit("a-b"))
    return sg.paired_tests(pairs, ["pair"], alpha, zero_method)

"""How the experiment's parts are laid on the given tables.

documents = the collection, benchmark = the topics. A document is judged
relevant to a topic when it holds at least two distinct topic terms that occur
in at most 2 % of all documents. The index, the topic terms and the judgments
are stored once per application in the shared folder, as an experiment would.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ranklab.operators import index as ix, scoring as sc, term_layout as tl
from ranklab.session import join_small, keep, scalar, shared_folder, spread
from ranklab.sinks import index_store as store
from ranklab.sources import tagged

CUT = 10            # hits per topic in a search
TRAIN_CUT = 5       # hits per topic in training
RARE_SHARE = 0.02
RARE_TERMS = 2

_prepared: dict[tuple, "Experiment"] = {}
_runs: dict[tuple, DataFrame] = {}
_layouts: dict[tuple, tl.TermLayout] = {}


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").alias("contents"))


def doc_rows(spark: SparkSession, sf: str, copies: int = 1) -> DataFrame:
    return ix.with_row_ids(spread(documents(spark, sf), "doc_id"), copies=copies)


def bodies(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("doc_id"), F.col("text").alias("body"))


def topics(spark: SparkSession, sf: str, fuse_lines: bool = False) -> DataFrame:
    return tagged.topics_from(bodies(spark, sf), fuse_lines)


def derive_qrels(index: ix.Index, terms: sc.TopicTerms) -> DataFrame:
    """(query_id, doc_id) by the rule above, from rare topic terms only."""
    n = scalar(index.coll_stats, F.sum("n_docs"))
    rare = (sc.stats_of_terms(index, terms).where(F.col("df") <= F.lit(RARE_SHARE) * n)
            .select("query_id", "term"))
    rows = (join_small(index.postings, rare, "term", terms.n_bytes).groupBy("query_id", "row_id")
            .agg(F.count("*").alias("n")).where(F.col("n") >= RARE_TERMS))
    return rows.join(index.documents.select("row_id", "doc_id"), "row_id").select("query_id", "doc_id")


@dataclass(frozen=True)
class Experiment:
    index: ix.Index
    topics: DataFrame
    terms: sc.TopicTerms
    fused_terms: sc.TopicTerms
    qrels: DataFrame

    def halves(self) -> tuple["Experiment", "Experiment"]:
        """Training and held-out topics: all topics, split at the middle of their ids."""
        middle = scalar(self.topics, F.min("query_id") + F.max("query_id"))
        low, high = 2 * F.col("query_id") <= middle, 2 * F.col("query_id") > middle
        return tuple(replace(self, topics=self.topics.where(half), terms=replace(
            self.terms, terms=self.terms.terms.where(half))) for half in (low, high))


def _prepare(spark: SparkSession, sf: str) -> Experiment:
    path = shared_folder(spark)
    store.create_index(documents(spark, sf), f"{path}/index")
    index = store.open_index(spark, f"{path}/index")
    terms = [sc.measured(keep(sc.query_terms(topics(spark, sf, fuse)))) for fuse in (False, True)]
    return Experiment(index, topics(spark, sf), *terms, keep(derive_qrels(index, terms[0])))


def experiment(spark: SparkSession, sf: str) -> Experiment:
    """The stored parts for one set of tables, made on first use by an application."""
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _prepared:
        _prepared[key] = _prepare(spark, sf)
    return _prepared[key]


def layout(spark: SparkSession, sf: str) -> tl.TermLayout:
    """The experiment's postings by term, stored on first use."""
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _layouts:
        _layouts[key] = tl.store_layout(experiment(spark, sf).index)
    return _layouts[key]


def stored_run(spark: SparkSession, sf: str, model: str) -> DataFrame:
    """The ranking of all topics under TF-IDF, or under every lambda (`grid`), stored on first use like the index."""
    key = (spark.sparkContext.applicationId, id(spark), sf, model)
    if key not in _runs:
        e = experiment(spark, sf)
        _runs[key] = keep(sc.run(e.index, e.terms, CUT) if model == "tfidf" else sc.run_grid(e.index, e.terms, TRAIN_CUT))
    return _runs[key]

"""Scores of all topics against all documents in one job, and the best k per topic.

Topic terms carry everything that depends on the collection (idf, or the
collection probability), so the join with the postings is the only one needed:
length and frequency are already in each posting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.functions import text as tx
from ranklab.operators.index import Index, merge_term_stats
from ranklab.session import BROADCAST_BYTES, broadcast_if, estimated_bytes, join_small, scalar

# The smoothing weights that are tried in training.
LAMBDAS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
# Scores are compared in units of 1e-9, so the order of summation cannot decide a rank.
SCORE_UNITS = 1e9
# Row ids that share a bitmap.
BITMAP_ROWS = 32768
# Stored postings (times lambdas) from which on score bounds repay their extra pass.
BOUND_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class TopicTerms:
    """terms (query_id, term, qtf) with the measured size that decides on broadcasting."""

    terms: DataFrame
    n_rows: int
    n_topics: int
    n_bytes: int

    def run_bytes(self, k: int) -> int:
        """An upper bound for k hits per topic of about 64 bytes each."""
        return self.n_topics * k * 64


def query_terms(topics: DataFrame) -> DataFrame:
    """(query_id, term, qtf): a term that a topic repeats counts each time."""
    return (topics.select("query_id", F.inline(tx.term_runs(tx.tokens(F.col("text")))))
            .withColumnRenamed("tf", "qtf"))


def measure_terms(topics: DataFrame) -> TopicTerms:
    """Tokenise the topics and measure the result: one row comes to the driver."""
    return measured(query_terms(topics))


def measured(terms: DataFrame) -> TopicTerms:
    size = terms.agg(F.count("*").alias("n"), F.count_distinct("query_id").alias("topics"),
                     F.coalesce(F.sum(F.octet_length("term") + F.lit(64)), F.lit(0)).alias("bytes")).first()
    return TopicTerms(terms, size["n"], size["topics"], size["bytes"])


def stats_of_terms(index: Index, topics: TopicTerms) -> DataFrame:
    """Topic terms with df and cf. Other words are dropped before anything is merged."""
    vocabulary = topics.terms.select("term").distinct()
    wanted = index.term_stats.join(broadcast_if(vocabulary, topics.n_bytes), "term", "left_semi")
    return merge_term_stats(wanted).join(broadcast_if(topics.terms, topics.n_bytes), "term")


def doc_length(compat: Compat) -> Column:
    return tx.quantize_length(F.col("dl")) if compat.quantize else F.col("dl")


def term_weight(index: Index, copies: int = 1) -> Column:
    """qtf * (ln((N+1)/(df+1)) + 1).

    A collection of `copies` copies of each document has N and df times as large;
    no document needs to be stored twice for that.
    """
    n = scalar(index.coll_stats, F.sum("n_docs"))
    return F.col("qtf") * (F.ln((n * copies + 1) / (F.col("df") * copies + 1)) + 1)


def term_probability(index: Index, copies: int = 1) -> Column:
    """(cf+1)/(T+1), the collection probability."""
    n = scalar(index.coll_stats, F.sum("n_tokens"))
    return (F.col("cf") * copies + 1) / (n * copies + 1).cast("double")


def tfidf_weights(index: Index, topics: TopicTerms, copies: int = 1) -> DataFrame:
    """(query_id, term, weight, top_ratio)."""
    return stats_of_terms(index, topics).select("query_id", "term", term_weight(index, copies).alias("weight"), "top_ratio")


def jm_weights(index: Index, topics: TopicTerms, copies: int = 1) -> DataFrame:
    """(query_id, term, qtf, p, top_ratio), p the collection probability."""
    return stats_of_terms(index, topics).select(
        "query_id", "term", "qtf", term_probability(index, copies).alias("p"), "top_ratio")


def jm_log(lam: Column | float, ratio: Column) -> Column:
    """What a posting adds to a Jelinek-Mercer score for each time the topic has its term; `ratio` = (tf/length)/p. Zero at lambda 1."""
    return F.log1p((F.lit(1.0) - lam) / lam * ratio)


def jm_part(lam: Column | float, ratio: Column) -> Column:
    """One term of a Jelinek-Mercer score."""
    return F.col("qtf") * jm_log(lam, ratio)


def matches(index: Index, weights: DataFrame, topics: TopicTerms) -> DataFrame:
    """Postings of the topic terms, with whatever `weights` carries per (topic, term)."""
    return join_small(index.postings, weights, "term", topics.n_bytes)


def any_term_match(index: Index, topics: TopicTerms) -> DataFrame:
    """(query_id, row_id): documents that hold at least one term of the topic."""
    return matches(index, topics.terms, topics).select("query_id", "row_id").distinct()


def count_matches(pairs: DataFrame, copies: int = 1) -> DataFrame:
    """(query_id, n_matches) of distinct (query_id, row_id) pairs."""
    return pairs.groupBy("query_id").agg((F.count("*") * copies).alias("n_matches"))


def count_by_bitmaps(index: Index, topics: TopicTerms, copies: int = 1) -> DataFrame:
    """`count_matches` of `any_term_match`, counted in bitmaps: no (topic, document) pair leaves a task.

    A task sets a bit for each of its matches, 32768 row ids to a bitmap; only bitmaps are
    shuffled and joined by "or". Where row ids are so sparse that a bitmap would hold less than
    64 documents on average, the pairs themselves are smaller, and these are counted. Spark sorts all
    matches for bitmaps; a stored index has a document's matches in one task, whose pairs are
    hashed instead: nothing is sorted, and only counts are shuffled.
    """
    if index.rows is not None:
        return count_matches(any_term_match(index, topics), copies)
    stats = index.coll_stats.agg(F.sum("n_docs").alias("n"), (F.max("last_row") - F.min("first_row") + 1).alias("span")).first()
    if not stats["n"] or stats["span"] > stats["n"] * (BITMAP_ROWS // 64):
        return count_matches(any_term_match(index, topics), copies)
    row = F.col("row_id") + 1                                # numbers in a bitmap start at 1
    pairs = matches(index, topics.terms, topics).select("query_id", F.expr("bitmap_bucket_number(row_id + 1)").alias("bitmap"), row.alias("row"))
    bits = pairs.groupBy("query_id", "bitmap").agg(F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits"))
    return bits.groupBy("query_id").agg((F.sum(F.bitmap_count("bits")) * copies).alias("n_matches"))


def known_model(model: str, compat: Compat) -> str:
    """`tfidf` or `jm`; any other name is an error, or TF-IDF where names are lenient."""
    if model in ("tfidf", "jm"):
        return model
    if not compat.lenient_names:
        raise ValueError(f"unknown model {model!r}")
    return "tfidf"


def score(index: Index, topics: TopicTerms, model: str = "tfidf", lam: Column | float = 0.5,
          compat: Compat = STANDARD) -> DataFrame:
    """(query_id, row_id, score) of every document that shares a term with the topic."""
    length = doc_length(compat)
    if known_model(model, compat) == "tfidf":
        found = matches(index, tfidf_weights(index, topics, compat.copies), topics)
        part = F.col("weight") * F.sqrt("tf") / F.sqrt(length)
    else:
        lam = F.lit(lam) if isinstance(lam, (int, float)) else lam
        weights = jm_weights(index, topics, compat.copies).withColumn("lam", lam.cast("double"))
        found = matches(index, weights, topics)
        part = jm_part(F.col("lam"), F.col("tf") / length / F.col("p"))
    return found.groupBy("query_id", "row_id").agg(F.sum(part).alias("score"))


def _behind(score: Column, bound: Column, last: Column) -> Column:
    """Documents that lose against the k leading ones (see `best_hits`); false where there is no bound."""
    key = rank_key(score)
    return F.coalesce((key < bound) | ((key == bound) & (F.col("row_id") > last)), F.lit(False))


def _opened(wide: DataFrame, name: str, columns: Sequence[tuple], bounds: DataFrame | None) -> DataFrame:
    """(query_id, `name`, row_id, score) from sums side by side; `columns` has each value of `name` with its sum.

    With `bounds` (query_id, `name`, last, bound) only documents that are not behind are left. Those that are behind
    everywhere go before a row is opened up, by one lookup per topic and document.
    """
    fields = [[F.lit(x).alias(name), F.col(c).alias("score")] for x, c in columns]
    if bounds is not None:
        per_topic = bounds.groupBy("query_id").agg(*[F.max(F.when(F.col(name) == F.lit(x), F.col(c))).alias(f"{c}{i}")
                                                     for i, (x, _) in enumerate(columns) for c in ("bound", "last")])
        ahead = [~_behind(F.col(c), F.col(f"bound{i}"), F.col(f"last{i}")) for i, (_, c) in enumerate(columns)]
        wide = wide.join(F.broadcast(per_topic), "query_id", "left").where(reduce(or_, ahead))
        fields = [f + [F.col(f"{c}{i}").alias(c) for c in ("bound", "last")] for i, f in enumerate(fields)]
    rows = wide.select("query_id", "row_id", F.inline(F.array(*[F.struct(*f) for f in fields])))
    if bounds is not None:
        rows = rows.where(~_behind(F.col("score"), F.col("bound"), F.col("last")))
    return rows.select("query_id", name, "row_id", "score")


def score_models(index: Index, topics: TopicTerms, models: Sequence[str], lam: float = 0.5,
                 compat: Compat = STANDARD, bounds: DataFrame | None = None) -> DataFrame:
    """(query_id, model, row_id, score) under several models: one join and one aggregation for all of them."""
    weights = stats_of_terms(index, topics).select(
        "query_id", "term", "qtf", term_weight(index, compat.copies).alias("weight"), term_probability(index, compat.copies).alias("p"))
    length = doc_length(compat)
    parts = {"tfidf": F.col("weight") * F.sqrt("tf") / F.sqrt(length),
             "jm": jm_part(F.lit(float(lam)), F.col("tf") / length / F.col("p"))}
    asked = {m: known_model(m, compat) for m in models}
    wide = matches(index, weights, topics).groupBy("query_id", "row_id").agg(
        *[F.sum(parts[m]).alias(m) for m in parts if m in asked.values()])
    return _opened(wide, "model", list(asked.items()), bounds)


def score_grid(index: Index, topics: TopicTerms, lams: Sequence[float] = LAMBDAS,
               compat: Compat = STANDARD, bounds: DataFrame | None = None) -> DataFrame:
    """(query_id, lam, row_id, score): one scan of the postings and one aggregation for all lambdas.

    Logarithms depend on the posting alone, so they are taken before the topics that share its term are joined.
    """
    ratio = F.col("tf") / doc_length(compat) / F.col("p")
    terms = jm_weights(index, topics, compat.copies).select("term", "p").distinct()
    # `transform` makes the logarithms a column of their own, which Spark does not take again for each topic
    logs = tx.let(ratio, lambda r: F.transform(F.array(*[F.lit(float(x)) for x in lams]), lambda x: jm_log(x, r)))
    held = matches(index, terms, topics).select("term", "row_id", logs.alias("logs"))
    wide = join_small(held, topics.terms, "term", topics.n_bytes).groupBy("query_id", "row_id").agg(
        *[F.sum(F.col("qtf") * F.get("logs", F.lit(i))).alias(f"s{i}") for i in range(len(lams))])
    return _opened(wide, "lam", [(x, f"s{i}") for i, x in enumerate(lams)], bounds)


def rank_key(score: Column | None = None) -> Column:
    return F.rint((F.col("score") if score is None else score) * SCORE_UNITS)


def leading_documents(index: Index, k: int) -> Index:
    """The index with only the first sqrt(k * N) or so documents of its N; all statistics stay."""
    s = F.sum("n_docs").cast("double")
    span = F.max("last_row") - F.min("first_row") + 1
    end = F.min("first_row") + F.ceil(span * F.least(F.lit(1.0), F.sqrt(F.lit(float(k)) / s)))
    return replace(index, postings=index.postings.where(F.col("row_id") < scalar(index.coll_stats, end)))


def best_hits(index: Index, topics: TopicTerms, k: int, scorer: Callable[..., DataFrame],
              by: Sequence[str] = ("query_id",), groups: int = 1, copies: int = 1,
              bounded: bool | None = None, takes_bounds: bool = False) -> DataFrame:
    """`top_k` of all documents, without sorting them all.

    The k-th best score among the leading documents is a lower bound of the k-th
    best of all, so documents below it are dropped before the sort. At the bound,
    documents behind all k leading ones lose the tie and go as well. A topic with
    fewer than k leading matches has no bound. The result is that of `top_k`. The
    bounds are one row per topic (and lambda: `groups`); if they are too large to
    broadcast, or the postings too few to repay a second look, none are used.
    A scorer that `takes_bounds` drops the documents itself, before it opens up its rows.
    """
    scores, per_topic = scorer(index), -(-k // copies)
    if bounded is None:
        bounded = estimated_bytes(index.postings) * groups >= BOUND_BYTES
    if bounded and topics.n_topics * groups * 64 <= BROADCAST_BYTES:
        leading = top_k(scorer(leading_documents(index, per_topic)), per_topic, by)
        # One unit of slack, as the two sums of one document may be rounded apart;
        # parts are never negative, so a sum of zero is exact.
        bounds = leading.groupBy(*by).agg(
            F.count("*").alias("n"), F.max("row_id").alias("last"),
            F.greatest(F.min(rank_key()) - 1, F.lit(0.0)).alias("bound")).where(F.col("n") == per_topic)
        if takes_bounds:
            scores = scorer(index, bounds.drop("n"))
        else:
            scores = (scores.join(F.broadcast(bounds.drop("n")), list(by), "left")
                      .where(~_behind(F.col("score"), F.col("bound"), F.col("last"))).drop("last", "bound"))
    return top_k(scores, k, by, copies)


def top_k(scores: DataFrame, k: int, by: Sequence[str] = ("query_id",), copies: int = 1) -> DataFrame:
    """Best k hits per topic with their rank; equal scores stand in document order.

    Each task keeps its own best k before anything is shuffled. With `copies`,
    a document fills that many neighbouring ranks, row ids as if stored that often.
    """
    order = W.partitionBy(*by).orderBy(F.desc(rank_key()), "row_id")
    best = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= -(-k // copies))
    if copies > 1:
        best = (expand_copies(best.withColumnRenamed("rank", "first"), copies)
                .withColumn("rank", (F.col("first") - 1) * copies + F.col("row_id") % copies + 1)
                .where(F.col("rank") <= k).drop("first"))
    return best.withColumn("rank", F.col("rank").cast("int"))


def expand_copies(rows: DataFrame, copies: int) -> DataFrame:
    """One row per physical copy, with the row ids the copies would have been stored under."""
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            .withColumn("row_id", F.col("row_id") * copies + F.col("copy")).drop("copy"))


def with_documents(run: DataFrame, documents: DataFrame, run_bytes: int, copies: int = 1,
                   fields: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Fetch stored fields of the hits. The run, not the collection, is the side that moves."""
    stored = documents.select(F.col("row_id").alias("stored_row"), *fields)
    keyed = run.withColumn("stored_row", F.floor(F.col("row_id") / copies).cast("bigint")) \
        if copies > 1 else run.withColumn("stored_row", F.col("row_id"))
    return stored.join(broadcast_if(keyed, run_bytes), "stored_row").drop("stored_row")


def run(index: Index, topics: TopicTerms, k: int, model: str = "tfidf", lam: Column | float = 0.5,
        compat: Compat = STANDARD) -> DataFrame:
    """(query_id, row_id, score, rank, doc_id): the ranking of every topic."""
    best = best_hits(index, topics, k, lambda part: score(part, topics, model, lam, compat), copies=compat.copies)
    return with_documents(best, index.documents, topics.run_bytes(k), compat.copies)


def run_grid(index: Index, topics: TopicTerms, k: int, lams: Sequence[float] = LAMBDAS,
             compat: Compat = STANDARD) -> DataFrame:
    """The rankings of every topic under every lambda."""
    best = best_hits(index, topics, k, lambda part, bounds=None: score_grid(part, topics, lams, compat, bounds),
                     ("query_id", "lam"), len(lams), compat.copies, takes_bounds=True)
    return with_documents(best, index.documents, topics.run_bytes(k) * len(lams), compat.copies)


def run_models(index: Index, topics: TopicTerms, k: int, models: Sequence[str], lam: float = 0.5,
               compat: Compat = STANDARD) -> DataFrame:
    """The rankings of every topic under every model, from one scan of the postings."""
    best = best_hits(index, topics, k, lambda part, bounds=None: score_models(part, topics, models, lam, compat, bounds),
                     ("query_id", "model"), len(models), compat.copies, takes_bounds=True)
    return with_documents(best, index.documents, topics.run_bytes(k) * len(models), compat.copies)


def display_top(ranked: DataFrame, top: int, cut: int) -> DataFrame:
    """The best `top` of the `cut` hits that were kept."""
    return ranked.where(F.col("rank") <= F.least(F.lit(top), F.lit(cut)))

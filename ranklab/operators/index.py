"""Postings and statistics of a collection.

A document is one row, so its words are counted inside that row: the postings
table costs no shuffle. Only term statistics are grouped by term, with partial
sums first, so the term that occurs everywhere is one row per task by then.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from ranklab.functions import text as tx
from ranklab.session import keep, spread


@dataclass(frozen=True)
class Index:
    """documents (row_id, doc_id, dl), postings (term, row_id, tf, dl),
    term_stats (term, df, cf, top_ratio): one row per term and batch, to be merged,
    coll_stats (n_docs, n_tokens, first_row, last_row): one row per batch,
    rows (row_id, doc_id, dl, contents, terms, positions): a stored index's nested rows, else None."""

    documents: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    coll_stats: DataFrame
    rows: DataFrame | None = None


# Ids below this leave room for the ids of later batches and of copies.
LARGEST_ID = 1 << 60


def lowest_id(docs: DataFrame) -> int | None:
    """The lowest id where the ids tell all rows apart and are in [0, LARGEST_ID), else None: one pass over the ids alone."""
    seen = docs.groupBy("doc_id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.coalesce(F.max(F.col("doc_id").isNull()), F.lit(False)).alias("unnamed")).first()
    low = seen["low"] or 0
    usable = seen["most"] <= 1 and not seen["unnamed"] and low >= 0 and (seen["high"] or 0) < LARGEST_ID
    return low if usable else None


def with_row_ids(docs: DataFrame, first: int = 0, copies: int = 1, lowest: int | None = None) -> DataFrame:
    """Add row_id, the physical document, in doc_id order; each document `copies` times.

    Where the ids can serve as row ids they do. Where ids repeat (or are missing, negative
    or hashes of 64 bits), rows are numbered from `first` on in the order of id, then text: sorted
    over ranges of ids, each range counted, and the counts before it added. A row's
    number never depends on another row having a different id. A column row_id is replaced.
    With `lowest` that is the lowest number given, whatever the ids are.
    """
    docs = docs.drop("row_id")
    low = lowest_id(docs)
    if lowest is not None:
        first = lowest - (low or 0)
    if low is not None:
        numbered = docs.withColumn("row_id", F.col("doc_id") + F.lit(first))
    else:
        text = [F.xxhash64(c) for c in ("contents",) if c in docs.columns]
        sorted_ = keep(docs.repartitionByRange("doc_id", *text).sortWithinPartitions("doc_id", *text).withColumns(
            {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
        before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        offsets = sorted_.groupBy("part").agg(F.count("*").alias("n")).select("part", before.alias("before"))  # a row per range
        numbered = sorted_.join(F.broadcast(offsets), "part").withColumn(
            "row_id", F.lit(first) + F.col("before") + F.col("at")).drop("part", "at", "before")
    if copies == 1:
        return numbered
    return (numbered.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
            .withColumn("row_id", F.lit(first) + (F.col("row_id") - first) * copies + F.col("copy")).drop("copy"))


def postings(docs: DataFrame, positions: bool = False, text: str = "contents") -> DataFrame:
    """(term, row_id, tf, dl[, positions]) from (row_id, contents)."""
    runs = tx.term_positions if positions else tx.term_runs
    words = docs.select("row_id", tx.tokens(F.col(text)).alias("words"))
    found = words.select("row_id", F.size("words").alias("dl"), F.inline(runs(F.col("words"))))
    columns = ["term", "row_id", "tf", "dl"] + (["positions"] if positions else [])
    return found.select(*columns)


def term_vectors(docs: DataFrame, text: str = "contents") -> DataFrame:
    """(row_id, vector): map from term to its positions, built inside the document's row."""
    runs = tx.term_positions(tx.tokens(F.col(text)))
    entries = F.transform(runs, lambda r: F.struct(r.getField("term"), r.getField("positions")))
    return docs.select("row_id", F.map_from_entries(F.coalesce(
        entries, F.array().cast("array<struct<term:string,positions:array<int>>>"))).alias("vector"))


def doc_lengths(docs: DataFrame, text: str = "contents") -> DataFrame:
    return docs.select("row_id", "doc_id", F.size(tx.tokens(F.col(text))).alias("dl"))


def term_stats(posts: DataFrame, *by: str) -> DataFrame:
    """Per term (and `by`): documents, occurrences, and the highest share it has of any document."""
    return posts.groupBy("term", *by).agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf"),
        F.max(F.col("tf") / F.col("dl")).alias("top_ratio"))


def merge_term_stats(parts: DataFrame) -> DataFrame:
    """Statistics of several batches as one; no posting is read again. Batches of removed documents count negative."""
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"),
                                    F.max("top_ratio").alias("top_ratio")).where("df > 0")


def coll_stats(documents: DataFrame, *by: str) -> DataFrame:
    return documents.groupBy(*by).agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).alias("n_tokens"),
                         F.min("row_id").alias("first_row"), F.max("row_id").alias("last_row"))


def build_index(docs: DataFrame, copies: int = 1, positions: bool = False) -> Index:
    """Index of (doc_id, contents), lazily: nothing is stored."""
    rows = with_row_ids(spread(docs, "doc_id"), copies=copies)
    posts = postings(rows, positions)
    documents = doc_lengths(rows)
    return Index(documents, posts, term_stats(posts), coll_stats(documents))


def upsert_docs(old: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """Replace the documents that come again; keep the others; add the new ones."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def merge_coll_stats(parts: DataFrame) -> DataFrame:
    return parts.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def _behind(old: Index, new: Index) -> Index:
    """`new` with row ids above all of `old`."""
    last = old.coll_stats.agg(F.max("last_row").alias("n")).first()["n"]
    start = new.coll_stats.agg(F.min("first_row").alias("n")).first()["n"]
    if last is None or start is None or start > last:
        return new
    up = F.lit(last + 1 - start)
    moved = {t: getattr(new, t).withColumn("row_id", F.col("row_id") + up) for t in ("documents", "postings")}
    stats = new.coll_stats.withColumns({c: F.col(c) + up for c in ("first_row", "last_row")})
    return Index(moved["documents"], moved["postings"], new.term_stats, stats)


def merge_index(old: Index, new: Index) -> Index:
    """Append: all tables of both, the new rows numbered behind the old ones; statistics are merged on use, not recounted."""
    new = _behind(old, new)
    return Index(*[getattr(old, t).unionByName(getattr(new, t))
                   for t in ("documents", "postings", "term_stats", "coll_stats")])


def upsert_index(old: Index, new: Index) -> Index:
    """Documents of `new` replace those of `old` with the same doc_id; only the replaced ones are subtracted from the statistics."""
    gone = old.documents.join(new.documents.select("doc_id").distinct(), "doc_id", "left_semi").select("row_id", "dl")
    rows = gone.select("row_id")
    lost = term_stats(old.postings.join(rows, "row_id", "left_semi")).select(
        "term", (-F.col("df")).alias("df"), (-F.col("cf")).alias("cf"), "top_ratio")
    fewer = gone.agg((-F.count("*")).alias("n_docs"), (-F.coalesce(F.sum("dl"), F.lit(0))).alias("n_tokens")).select(
        "*", *[F.lit(None).cast("bigint").alias(c) for c in ("first_row", "last_row")])
    left = Index(old.documents.join(rows, "row_id", "left_anti"), old.postings.join(rows, "row_id", "left_anti"),
                 old.term_stats.unionByName(lost), old.coll_stats.unionByName(fewer))
    return merge_index(left, new)

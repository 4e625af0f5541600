"""A second layout of the postings, by term, for searches that touch few of them.

The tables are partitioned by a hash of the term (a folder each) and sorted by term and row, so
that a search reads only the folders of its terms, of postings and statistics alike. Rows
are also cut into blocks of consecutive row ids; `blocks` holds, per term and block, the highest
share that the term has of a document there. Sums of these bound every score of a block, so
that a top-k search can leave out the postings of blocks that cannot reach the k best hits
(block-max pruning).

Inside a folder the files are buckets of whole blocks. Documents move once, when the layout is written, as
a line of their words and an array of counts; after that the postings of a document lie in one bucket,
so that blocks are counted, bounds added and documents scored without moving a posting, and a term that
fills a third of all postings is spread over all buckets.

The layout by document (`sinks/index_store.py`) reads whole documents in any search;
this one reads less for rare terms and few topics. Both give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.operators import scoring as sc
from ranklab.operators.index import Index, term_stats
from ranklab.session import BROADCAST_BYTES, broadcast_if, bucketed_table, keep, shared_folder, table_name

BLOCK_ROWS = 128                    # row ids in a block
FOLDERS = 4                         # each bucket has a file in each folder
NAMED_TERMS = 10                    # terms that a scan names, to read their pages only; Spark hands on no more to Parquet
POSTING_BYTES = 12                  # of a posting in a file, about
SORT_BYTES = 16 * 1024 * 1024       # of postings in a bucket, which one task sorts; in memory about eight times that
BUCKET_DOCS = 4096                  # in a bucket, about, so that the scores of all topics there fit into a task's memory
SEED_BLOCKS = 2                     # blocks per topic whose exact scores give the first bound
TOPIC_BITS = 64                     # topics in a word of a bit field

_POSTINGS = "term STRING, row_id BIGINT, tf INT, dl INT, block BIGINT, part INT"
_BLOCKS = "term STRING, block BIGINT, df BIGINT, cf BIGINT, top_ratio DOUBLE, part INT"
_STATS = "term STRING, df BIGINT, cf BIGINT, top_ratio DOUBLE, part INT"
_LAYOUT = "folders INT, buckets INT"


@dataclass(frozen=True)
class TermLayout:
    """Tables with the partition column `part`; `index` is the index they were made from."""

    index: Index
    postings: DataFrame
    blocks: DataFrame
    term_stats: DataFrame
    folders: int

    def pruned(self, topics: sc.TopicTerms) -> "TermLayout":
        """Only the folders of the topics' terms: at most `folders` numbers come to the driver, and the terms if they are few."""
        needed = [r["part"] for r in topics.terms.select(part_of(self.folders)).distinct().collect()]
        here = F.col("part").isin(needed)
        if topics.n_rows <= NAMED_TERMS:
            here &= F.col("term").isin([r["term"] for r in topics.terms.select("term").distinct().collect()])
        return replace(self, postings=self.postings.where(here), blocks=self.blocks.where(here), term_stats=self.term_stats.where(here))

    def as_index(self) -> Index:
        """The same tables for all searches of `scoring`."""
        return replace(self.index, postings=self.postings.select("term", "row_id", "tf", "dl"),
                       term_stats=self.term_stats.drop("part"))


def part_of(folders: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(folders)).cast("int").alias("part")


def _bucketed(spark: SparkSession, path: str, name: str, buckets: int) -> DataFrame:
    schema, order = {"postings": (_POSTINGS, "term, row_id"), "blocks": (_BLOCKS, "term, block")}[name]
    return bucketed_table(spark, table_name(f"{path}/{name}"), f"{path}/{name}", schema, "block", order, buckets)


def write_layout(index: Index, path: str, folders: int | None = None, block_rows: int = BLOCK_ROWS) -> None:
    """Write the layout of `index` below `path`: postings first, and what is counted from them."""
    spark = index.postings.sparkSession
    total = index.coll_stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_docs")]).first()
    size = total["n_tokens"] * POSTING_BYTES                 # at most one posting a word
    folders = folders or FOLDERS
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // SORT_BYTES), -(-total["n_docs"] // BUCKET_DOCS))
    for name, schema in (("postings", _POSTINGS), ("blocks", _BLOCKS)):
        spark.sql(f"DROP TABLE IF EXISTS {table_name(f'{path}/{name}')}")
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([(folders, tasks)], _LAYOUT).write.mode("overwrite").parquet(f"{path}/layout")
    stored, blocks = [_bucketed(spark, path, name, tasks) for name in ("postings", "blocks")]
    block = F.floor(F.col("row_id") / block_rows).cast("bigint").alias("block")
    _by_block(index, block, tasks).select("term", "row_id", "tf", "dl", "block", part_of(folders)).write.insertInto(table_name(f"{path}/postings"))
    stored, blocks = [_bucketed(spark, path, name, tasks) for name in ("postings", "blocks")]
    term_stats(stored, "part", "block").select(*blocks.columns).write.insertInto(table_name(f"{path}/blocks"))
    stats = _bucketed(spark, path, "blocks", tasks).groupBy("part", "term").agg(
        F.sum("df").alias("df"), F.sum("cf").alias("cf"), F.max("top_ratio").alias("top_ratio"))
    _sorted(stats, tasks, "part", "term").write.partitionBy("part").mode("overwrite").parquet(f"{path}/term_stats")


def _by_block(index: Index, block: Column, tasks: int) -> DataFrame:
    """(term, row_id, tf, dl, block), each block in one of `tasks` partitions. Rows of a stored index move as
    one line of words (which hold no blanks) and their counts, a third of what their postings take."""
    if index.rows is None:
        return index.postings.select("term", "row_id", "tf", "dl", block).repartition(tasks, "block")
    docs = index.rows.select("row_id", "dl", block, F.array_join("terms.term", " ").alias("words"), F.col("terms.tf").alias("counts"))
    opened = F.arrays_zip(F.split("words", " ").alias("term"), F.col("counts").alias("tf"))
    return docs.repartition(tasks, "block").select("row_id", "dl", "block", F.inline(opened))


def _sorted(rows: DataFrame, tasks: int, *by: str) -> DataFrame:
    return rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by)


def open_layout(spark: SparkSession, path: str, index: Index) -> TermLayout:
    folders, buckets = spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first()
    tables = [_bucketed(spark, path, name, buckets) for name in ("postings", "blocks")]
    return TermLayout(index, *tables, spark.read.schema(_STATS).parquet(f"{path}/term_stats"), folders)


def store_layout(index: Index) -> TermLayout:
    """A layout in the shared folder."""
    path = shared_folder(index.postings.sparkSession)
    write_layout(index, path)
    return open_layout(index.postings.sparkSession, path, index)


def _parts(layout: TermLayout, topics: sc.TopicTerms, model: str, lam: float, compat: Compat) -> tuple[DataFrame, Column]:
    """What a topic's term carries, and the part of the score that a share `ratio` of a document gives. It rises with the share."""
    if model == "tfidf":
        return sc.tfidf_weights(layout.as_index(), topics, compat.copies), F.col("weight") * F.sqrt("ratio")
    if model == "jm":
        return sc.jm_weights(layout.as_index(), topics, compat.copies), sc.jm_part(F.lit(lam), F.col("ratio") / F.col("p"))
    raise ValueError(f"unknown model {model!r}")


def _numbered(weights: DataFrame, topics: sc.TopicTerms) -> DataFrame:
    """`weights` with the place (word, bit) of each topic in a bit field of all topics."""
    at = F.row_number().over(W.orderBy("query_id")) - 1          # a row per topic
    places = weights.select("query_id").where("query_id is not null").distinct().select(
        "query_id", F.floor(at / TOPIC_BITS).cast("int").alias("word"), (at % TOPIC_BITS).cast("int").alias("bit"))
    return weights.join(broadcast_if(places, topics.n_topics * 64), "query_id")


def top_k_by_blocks(layout: TermLayout, topics: sc.TopicTerms, k: int, model: str = "tfidf", lam: float = 0.5,
                    compat: Compat = STANDARD) -> DataFrame:
    """(query_id, row_id, score, rank): the k best hits per topic, as `scoring.best_hits` has them.

    The bounds of all blocks come from `blocks`. The blocks with the highest ones are scored first; the
    k-th best score there is a lower bound of the k-th best of all, and only blocks whose bound
    reaches it are joined with the postings. Ties are kept: a block at the bound is read.
    Buckets hold whole blocks, so that bounds and scores are summed where the rows lie.
    """
    layout = layout.pruned(topics)
    weights, part = _parts(layout, topics, model, lam, compat)
    weights = keep(_numbered(weights.drop("top_ratio"), topics))
    # lengths that are rounded down make a share larger than it is stored: the bound follows
    room = 8 / 7 if compat.quantize else 1.0
    terms = sc.join_small(layout.blocks.select("term", "block", (F.col("top_ratio") * room).alias("ratio"), F.col("block").alias("row_id")),
                          weights, "term", topics.n_bytes).drop("row_id")
    bounds = keep(terms.groupBy("query_id", "word", "bit", "block").agg(F.sum(part).alias("score")).select(
        "query_id", "word", "bit", "block", sc.rank_key().alias("bound")))
    per_topic = -(-k // compat.copies)
    seeds = sc.top_k(bounds.select("query_id", "word", "bit", F.col("block").alias("row_id"), (F.col("bound") / sc.SCORE_UNITS).alias("score")),
                     SEED_BLOCKS).withColumnRenamed("row_id", "block")
    leading = sc.top_k(_scores(layout, weights, part, seeds, topics.n_topics * SEED_BLOCKS, topics, compat), per_topic)
    least = keep(leading.groupBy("query_id").agg(F.count("*").alias("n"), F.min(sc.rank_key()).alias("least")).where(
        F.col("n") == per_topic).drop("n"))

    def reaching(rows: DataFrame, key: Column) -> DataFrame:
        # one unit of slack for each of the two sums, which are rounded apart
        behind = F.coalesce(key < F.col("least") - 2, F.lit(False))
        return rows.join(broadcast_if(least, topics.n_topics * 64), "query_id", "left").where(~behind).drop("least")

    wanted = keep(reaching(bounds, F.col("bound")).drop("bound"))
    n_blocks = wanted.agg(F.count_distinct("block")).first()[0]
    return sc.top_k(reaching(_scores(layout, weights, part, wanted, n_blocks, topics, compat), sc.rank_key()), k, copies=compat.copies)


def _scores(layout: TermLayout, weights: DataFrame, part: Column, wanted: DataFrame, n_blocks: int, topics: sc.TopicTerms,
            compat: Compat) -> DataFrame:
    """Exact scores of the documents in the `wanted` (query_id, word, bit, block), from these blocks' postings alone.

    A block's topics are bits beside its number, so what is joined with the postings is a row per block; where these are
    too many to broadcast, they are dealt to the buckets. The postings stay where they are.
    """
    n_words = max(1, -(-topics.n_topics // TOPIC_BITS))
    bits = wanted.groupBy("block", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    words = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    per_block = bits.groupBy("block").agg(words.alias("words")).select("block", F.transform(
        F.sequence(F.lit(0), F.lit(n_words - 1)), lambda w: F.coalesce(F.try_element_at("words", w), F.lit(0).cast("bigint"))).alias("topics"))
    small = n_blocks * (64 + 8 * n_words) <= BROADCAST_BYTES
    here = layout.postings.join(F.broadcast(per_block) if small else per_block.hint("shuffle_hash"), "block")
    found = sc.join_small(here, weights, "term", topics.n_bytes).where("(shiftright(get(topics, word), bit) & 1L) = 1L")
    ratio = F.col("tf") / sc.doc_length(compat)
    scores = found.withColumn("ratio", ratio).groupBy("query_id", "block", "row_id").agg(F.sum(part).alias("score"))
    return scores.select("query_id", "row_id", "score")


def rare_term_postings(layout: TermLayout, topics: sc.TopicTerms, most: int) -> DataFrame:
    """(query_id, term, row_id, qtf, tf): postings of the topic terms that at most `most` documents hold."""
    layout = layout.pruned(topics)
    rare = sc.stats_of_terms(layout.as_index(), topics).where(F.col("df") <= most).select("query_id", "term", "qtf")
    return sc.join_small(layout.postings, rare, "term", topics.n_bytes).select("query_id", "term", "row_id", "qtf", "tf")

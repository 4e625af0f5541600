"""The stored index: one nested row per document, bucketed by document.

`rows` holds (row_id, doc_id, dl, contents, terms, positions, batch): stored fields, term vector
and positions of a document in one row, written in one pass over the texts. Postings are these
rows opened up, and document lengths two of their columns, so neither is stored again.

Hash-partitioning the documents once, before they are tokenised, puts all postings of a
document into one bucket. Every later search then joins the broadcast topic terms, sums the
scores and takes the local top k without moving a posting; only k rows per task and topic are
shuffled. A term that fills a third of all postings is spread over all buckets like any other.

All tables are partitioned by `part`, a hash of doc_id, so that documents with one id share a
part. Replacing documents overwrites the parts that hold their ids and recounts the statistics of
these parts. Every row carries the batch that wrote it; readers keep the rows of batches in the
small table `batches`, whose row is written last, so what a failed append left is never seen. A failed
`upsert_index` loses no stored document but the replaced ones, and is mended by running it again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ranklab.functions import text as tx
from ranklab.operators import index as ix
from ranklab.session import broadcast_if, bucketed_table, keep, settings, table_name

# Text bytes and documents per bucket, which is one task of a search: the scores of all topics for its documents
# have to fit into a task's memory. Larger collections have more buckets, not larger ones. Text bytes per file of a
# bucket; a bucket has one file in each part.
BUCKET_BYTES = 8 * 1024 * 1024
BUCKET_DOCS = 4096
FILE_BYTES = 2 * 1024 * 1024
# Hits up to which their row ids are named in the scan, which then reads their buckets and row groups only.
NAMED_ROWS = 1000

_ROWS = ("row_id BIGINT, doc_id BIGINT, dl INT, contents STRING, terms ARRAY<STRUCT<term: STRING, tf: INT>>, "
         "positions ARRAY<ARRAY<INT>>, batch STRING, part INT")
_TERMS = "term STRING, df BIGINT, cf BIGINT, top_ratio DOUBLE, batch STRING, part INT"
_COLL_STATS = "n_docs BIGINT, n_tokens BIGINT, first_row BIGINT, last_row BIGINT, batch STRING, part INT"
_LAYOUT = "buckets INT, parts INT"


def bucket_count(spark: SparkSession, n_bytes: int, n_docs: int = 0) -> int:
    """At least one bucket per core, more when the text is large or the documents are many."""
    return max(spark.sparkContext.defaultParallelism, -(-n_bytes // BUCKET_BYTES), -(-n_docs // BUCKET_DOCS))


def _name(path: str) -> str:
    return table_name(path)


def _rows(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The stored rows by a table name, which is how Spark learns of their bucketing."""
    return bucketed_table(spark, _name(path), f"{path}/rows", _ROWS, "row_id", "row_id", buckets)


def _layout(spark: SparkSession, path: str) -> tuple[int, int]:
    return tuple(spark.read.schema(_LAYOUT).parquet(f"{path}/layout").first())


def _batches(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The finished batches and a bound of their bytes."""
    done = spark.read.schema("batch STRING").parquet(f"{path}/batches")
    return done, done.count() * 64


def _visible(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    done, size = _batches(spark, path)
    return table.join(broadcast_if(done, size), "batch", "left_semi")


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")


def _nested(docs: DataFrame, first: int | None, parts: int, buckets: int, batch: str) -> DataFrame:
    """Rows to store of (doc_id, contents), numbered from `first` on (None: a new index)."""
    numbered = ix.with_row_ids(docs.select("doc_id", "contents"), lowest=first)
    words = numbered.repartition(buckets, "row_id").withColumn("words", tx.tokens(F.col("contents")))
    placed = words.withColumns({"dl": F.coalesce(F.size("words"), F.lit(0)), "placed": tx.placed_words(F.col("words"))}).drop("words")
    runs = placed.withColumn("runs", tx.nested_terms(F.col("placed")))
    return runs.select("row_id", "doc_id", "dl", "contents", "runs.terms", "runs.positions",
                       F.lit(batch).alias("batch"), _part(parts).alias("part"))


def postings_of(rows: DataFrame, *kept: str) -> DataFrame:
    """(term, row_id, tf, dl and `kept`): stored rows opened up; a document's postings stay in its partition."""
    return rows.select("row_id", "dl", *kept, F.inline("terms")).select("term", "row_id", "tf", "dl", *kept)


def positions_of(rows: DataFrame) -> DataFrame:
    """(row_id, term, positions) from the stored rows."""
    return rows.select("row_id", F.inline(F.arrays_zip(F.col("terms.term").alias("term"), "positions")).alias("term", "positions"))


def vectors_of(rows: DataFrame) -> DataFrame:
    """(row_id, vector): the stored map from term to its positions; empty for a document without words."""
    some = F.map_from_arrays(F.col("terms.term"), "positions")
    return rows.select("row_id", F.coalesce(some, F.expr("cast(map() as map<string, array<int>>)")).alias("vector"))


def fetch(index: ix.Index, hits: DataFrame, n_hits: int, fields: tuple[str, ...] = ("doc_id", "contents")) -> DataFrame:
    """`hits` with stored fields of their rows. Of few hits the scan names the row ids, so that it
    reads their buckets, and there the row groups that hold them; of many it is joined with them."""
    stored = index.rows.select("row_id", *fields)
    if n_hits <= NAMED_ROWS:
        stored = stored.where(F.col("row_id").isin([r["row_id"] for r in hits.select("row_id").distinct().collect()]))
    return stored.join(broadcast_if(hits, n_hits * 64), "row_id")


def _count(spark: SparkSession, rows: DataFrame, path: str, mode: str, batch: str) -> None:
    """Write the statistics of `rows` per part, as those of `batch`. In mode `overwrite` they replace those of the same parts."""
    terms = ix.term_stats(postings_of(rows, "part"), "part").withColumn("batch", F.lit(batch))
    sums = ix.coll_stats(rows, "part").withColumn("batch", F.lit(batch))
    # a part without a word left is still overwritten
    empty = sums.select("part").distinct().selectExpr("cast(null as string) term", "0L df", "0L cf", "0D top_ratio", "'' batch", "part")
    for name, table, schema in (("term_stats", terms.unionByName(empty), _TERMS), ("coll_stats", sums, _COLL_STATS)):
        (table.select(*[c.split()[0] for c in schema.split(", ")]).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{path}/{name}"))


def _finish(spark: SparkSession, path: str, batch: str) -> None:
    spark.createDataFrame([(batch,)], "batch STRING").write.mode("append").parquet(f"{path}/batches")


def _above(stored: DataFrame) -> int:
    """The first row id above all that lie there, those of failed writes included."""
    last = stored.agg(F.max("row_id").alias("n")).first()["n"]
    return 0 if last is None else last + 1


def create_index(docs: DataFrame, path: str, buckets: int | None = None, parts: int | None = None) -> None:
    """Store a new index of (doc_id, contents); one that lies there is replaced. Other columns are left out."""
    spark = docs.sparkSession
    size, n_docs = docs.agg(F.coalesce(F.sum(F.octet_length("contents")), F.lit(0)), F.count("*")).first()
    buckets = buckets or bucket_count(spark, size, n_docs)
    parts = parts or max(1, size // (buckets * FILE_BYTES))
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    # from here on nothing of an index that lay here counts
    for name, schema in (("batches", "batch STRING"), ("rows", _ROWS), ("term_stats", _TERMS), ("coll_stats", _COLL_STATS)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([(buckets, parts)], _LAYOUT).write.mode("overwrite").parquet(f"{path}/layout")
    _add(docs, path, None)


def _add(docs: DataFrame, path: str, first: int | None) -> None:
    spark, batch = docs.sparkSession, uuid.uuid4().hex[:16]
    buckets, parts = _layout(spark, path)
    _rows(spark, path, buckets)
    _nested(docs, first, parts, buckets, batch).write.insertInto(_name(path))
    _count(spark, _rows(spark, path, buckets).where(F.col("batch") == batch), path, "append", batch)
    _finish(spark, path, batch)


def append_index(docs: DataFrame, path: str) -> None:
    """Add documents behind the stored ones. Only the new ones are tokenised and counted."""
    spark = docs.sparkSession
    _add(docs, path, _above(_rows(spark, path, _layout(spark, path)[0])))


def create_or_append_index(docs: DataFrame, path: str) -> None:
    try:
        docs.sparkSession.read.parquet(f"{path}/layout")
    except AnalysisException:
        create_index(docs, path)
    else:
        append_index(docs, path)


def upsert_index(docs: DataFrame, path: str) -> None:
    """Replace the stored documents whose doc_id comes again, and add the others, all behind the stored ones.

    Only parts that hold an id of `docs` are read and overwritten, and only their statistics are counted
    anew, so that these equal those of a fresh index. Rows that repeat an id in `docs` all stay; a
    null id replaces nothing. Without documents nothing happens. The new texts move once, into their buckets;
    of the stored rows only ids move, and those that stay are written again by the task that reads their bucket.
    """
    spark, batch = docs.sparkSession, uuid.uuid4().hex[:16]
    buckets, parts = _layout(spark, path)
    stored = _rows(spark, path, buckets)
    new = keep(docs.select("doc_id", "contents"))
    touched = [r["part"] for r in new.select(_part(parts).alias("part")).distinct().collect()]   # at most `parts` numbers
    if not touched:
        return
    here = _visible(spark, path, stored.where(F.col("part").isin(touched)))
    gone = here.join(new.select("doc_id").distinct(), "doc_id", "left_semi").select("row_id")
    left = here.join(gone.hint("shuffle_hash"), "row_id", "left_anti")
    names = stored.columns
    added = _nested(new, _above(stored), parts, buckets, batch).select(*names)
    _finish(spark, path, batch)   # before its rows: the replaced and the new rows change places in one write
    with settings(spark, sources__partitionOverwriteMode="dynamic"):
        left.select(*names).unionByName(added).write.insertInto(_name(path), overwrite=True)
    _count(spark, _rows(spark, path, buckets).where(F.col("part").isin(touched)), path, "overwrite", batch)


def write_index(docs: DataFrame, path: str, mode: str = "create", lenient: bool = False) -> None:
    """`create`, `append`, `create_or_append` or `upsert`; any other name is an error unless lenient."""
    writers = {"create": create_index, "append": append_index, "create_or_append": create_or_append_index, "upsert": upsert_index}
    if mode not in writers and not lenient:
        raise ValueError(f"unknown index mode {mode!r}")
    writers.get(mode, create_index)(docs, path)


def open_index(spark: SparkSession, path: str) -> ix.Index:
    """The stored tables. Statistics hold a row per part and batch; their users add them up."""
    rows = _visible(spark, path, _rows(spark, path, _layout(spark, path)[0])).drop("batch", "part")
    stats = {name: _visible(spark, path, spark.read.schema(schema).parquet(f"{path}/{name}")).drop("batch", "part")
             for name, schema in (("term_stats", _TERMS), ("coll_stats", _COLL_STATS))}
    return ix.Index(rows.select("row_id", "doc_id", "dl"), postings_of(rows), rows=rows, **stats)


def count_documents(index: ix.Index) -> DataFrame:
    return ix.merge_coll_stats(index.coll_stats).select("n_docs")

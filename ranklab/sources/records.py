"""Document files: an integer line, body lines, a `/` line; may repeat in one file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ranklab.functions import text as tx
from ranklab.sources.tagged import read_tagged

# A line that is `/` once blanks and control characters are cut off.
_END_LINE = r"(?m)^[\x00-\x09\x0b-\x20]*/[\x00-\x09\x0b-\x20]*(?:\n|\z)"


def records_in(chunks: DataFrame, text: str = "value") -> DataFrame:
    """Replace text chunks of whole records by (doc_id, contents); other columns stay.

    Between two `/` lines there is at most one record: it starts at the first
    line that is an integer; whatever stands before it is skipped. Every body
    line is followed by one blank in `contents`.
    """
    kept = [c for c in chunks.columns if c != text]
    parts = chunks.select(*kept, F.explode(F.split(tx.unix_lines(F.col(text)), _END_LINE)).alias("part"))
    return _record_of(parts.select(*kept, F.split(F.regexp_replace("part", r"\n\z", ""), "\n").alias("lines")), kept)


def _record_of(lined: DataFrame, kept: list[str]) -> DataFrame:
    """The record in each list of lines; lists without an integer line have none."""
    is_id = F.transform("lines", lambda line: tx.parse_int(line).isNotNull())
    found = lined.withColumn("at", F.array_position(is_id, F.lit(True)).cast("int")).where("at > 0")
    return (found.select(*kept, F.get("lines", F.col("at") - 1).cast("bigint").alias("doc_id"),
                         F.slice("lines", F.col("at") + 1, F.size("lines")).alias("body"))
            .select(*kept, "doc_id", F.when(F.size("body") > 0, tx.join_lines_space(F.col("body")))
                    .otherwise("").alias("contents")))


def read_records(spark: SparkSession, path: str, skip_unreadable: bool = False, line_end: str | None = None) -> DataFrame:
    """(path, doc_id, contents) of every file below a folder, or of one file.

    Files are read line by line, so that any line end and blanks around the `/` may stand in one
    file and a large file is still split. The lines move once, by split, and are numbered there by the
    `/` lines before them; a record that begins and ends in a split is whole. Of the others, the first and the
    last piece of each split, the counts of earlier splits of the file make one number of the record, by
    which these pieces move once more.

    With `line_end`, all records are known to end with exactly `line_end`, `/`, `line_end`: that is then
    the reader's separator, and nothing moves. Empty files have no records; a last record needs no `/`
    line. A file that cannot be read is an error; with `skip_unreadable` Spark logs its path and goes on.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", skip_unreadable)
    path_column = F.col("_metadata.file_path").alias("path")
    if line_end is not None:
        return records_in(reader.option("lineSep", f"{line_end}/{line_end}").text(path).select(path_column, "value"))
    lines = reader.text(path).select(path_column, F.col("_metadata.file_block_start").alias("split"), "value",
                                     (tx.trim_controls(F.col("value")) == "/").alias("ends"))
    n_ends = F.sum(F.col("ends").cast("long"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy("path", "split").agg(n_ends.alias("n")).select(
        "path", "split", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    above = Window.partitionBy("path", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (lines.withColumn("at", F.monotonically_increasing_id())
              .withColumn("here", F.coalesce(n_ends.over(above), F.lit(0))).groupBy("path", "split", "here")
              .agg(F.array_sort(F.collect_list(F.when(~F.col("ends"), F.struct("at", "value")))).alias("told"), F.max("ends").alias("ended"))
              .select("path", "split", "here", F.col("told.value").alias("lines"), ((F.col("here") > 0) & F.col("ended")).alias("whole")))
    parts = (pieces.where("not whole").join(counts, ["path", "split"])
             .groupBy("path", (F.col("before") + F.col("here")).alias("record"))
             .agg(F.array_sort(F.collect_list(F.struct("split", "lines"))).alias("told")))
    return _record_of(pieces.where("whole").select("path", "lines").unionByName(
        parts.select("path", F.flatten(F.col("told.lines")).alias("lines"))), ["path"])


def record_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverse of `read_records`: one text value per record, ready for `write.text`. A null text is an empty one."""
    return docs.withColumn("value", F.concat(F.col(key).cast("string"), F.lit("\n"), F.coalesce(F.col(text), F.lit("")), F.lit("\n/")))


def read_collection(spark: SparkSession, path: str, skip_unreadable: bool = False, line_end: str | None = None) -> DataFrame:
    """(doc_id, contents): a path with `.ALL` or `.all` in it is a tagged collection,
    any other one a folder of document files."""
    if ".ALL" in path or ".all" in path:
        return read_tagged(spark, path).select(
            "doc_id", tx.join_lines_space(F.split("body", "\n")).alias("contents"))
    return read_records(spark, path, skip_unreadable, line_end).select("doc_id", "contents")

"""Tagged collections and topics: `.I n`, `.W`, body lines.

The record mark is the reader's line separator, so one huge file is still split
over many tasks and no file per document is ever made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ranklab.functions import text as tx

_HEAD = r"^(?:\.I )?([0-9]+)[ \t]*\n\.W[ \t]*(?:\n|$)"


def read_tagged(spark: SparkSession, path: str, rejects: str = "fail") -> DataFrame:
    """(doc_id, body): one row per record; line breaks inside a body stay.

    A record needs `.W` right after its id line; blanks behind either are allowed. Ids need
    not be consecutive. Any other text between two marks is an error; with rejects="skip" it is
    left out, and `rejected_records` has it.
    """
    told = _records(spark, path)
    if rejects == "skip":
        told = told.where("doc_id is not null")
    elif rejects != "fail":
        raise ValueError(f"rejects is fail or skip, not {rejects!r}")
    doc_id = F.coalesce("doc_id", F.raise_error(F.concat(F.lit("no record: "), F.substring("record", 1, 80))).cast("bigint"))
    body = F.regexp_replace(F.regexp_replace("record", _HEAD, ""), r"\n+\z", "")
    return told.select(doc_id.alias("doc_id"), body.alias("body"))


def rejected_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): what `read_tagged` cannot read."""
    return _records(spark, path).where("doc_id is null").select("record")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(record, doc_id): the texts between record marks, blank ones left out; doc_id is null where one is no record."""
    record = tx.unix_lines(F.col("value"))
    return (spark.read.option("lineSep", "\n.I ").text(path).select(record.alias("record"))
            .where(F.col("record").rlike(r"\S"))
            .select("record", F.when(F.col("record").rlike(_HEAD), F.regexp_extract("record", _HEAD, 1).try_cast("bigint")).alias("doc_id")))


def topics_from(bodies: DataFrame, fuse_lines: bool = False, key: str = "doc_id",
                text: str = "body") -> DataFrame:
    """(query_id, text): lower-cased, line breaks become blanks, or nothing when fused."""
    lines = F.split(F.col(text), "\n")
    joined = tx.join_lines_fused(lines) if fuse_lines else F.array_join(lines, " ")
    return bodies.select(F.col(key).alias("query_id"), tx.trim_controls(tx.lower(joined)).alias("text"))


def read_topics(spark: SparkSession, path: str, ids: tuple[int, int] | None = None,
                fuse_lines: bool = False) -> DataFrame:
    """All topics of a file in one scan, optionally an inclusive range of ids."""
    topics = topics_from(read_tagged(spark, path), fuse_lines)
    return topics if ids is None else topics.where(F.col("query_id").between(*ids))


def parse_topic_range(text: str) -> tuple[int, int] | None:
    """`a-b`, `n` or `all` as an inclusive range of ids; None means no restriction."""
    if text == "all":
        return None
    parts = text.split("-")
    if len(parts) > 2 or not all(p.isdigit() for p in parts):
        raise ValueError(f"a topic selection is n, a-b or all, not {text!r}")
    return int(parts[0]), int(parts[-1])


def select_topics(topics: DataFrame, selection: str) -> DataFrame:
    ids = parse_topic_range(selection)
    return topics if ids is None else topics.where(F.col("query_id").between(*ids))


def union_topics(*selections: DataFrame) -> DataFrame:
    """Merge topic selections; of an id that occurs in several, the last selection's topic stays."""
    numbered = [t.withColumn("turn", F.lit(i)) for i, t in enumerate(selections)]
    merged = numbered[0]
    for more in numbered[1:]:
        merged = merged.unionByName(more)
    rest = [c for c in selections[0].columns if c != "query_id"]
    last = F.max(F.struct("turn", *rest)).alias("last")
    return merged.groupBy("query_id").agg(last).select("query_id", *[F.col(f"last.{c}").alias(c) for c in rest])


def tagged_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverse of `read_tagged`: one text value per record, ready for `write.text`. A null text is an empty one."""
    return docs.select(F.concat(F.lit(".I "), F.col(key).cast("string"), F.lit("\n.W\n"), F.coalesce(F.col(text), F.lit("")))
                       .alias("value"))

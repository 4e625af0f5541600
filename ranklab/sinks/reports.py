"""Result files as ordered text lines.

Each function returns (section, query_id, line_no, value); `write_lines` sorts on
the first three and writes. Large reports become several part files whose name
order is the line order; nothing is pulled into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ranklab.compat import STANDARD, Compat
from ranklab.operators.scoring import LAMBDAS

HEAD, BODY, FOOT = 0, 1, 2


def decimals(value: Column, digits: int = 6) -> Column:
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value)).otherwise("NaN")


def single(value: Column) -> Column:
    """A number as the original files print it: shortest single-precision form."""
    return value.cast("float").cast("string")


def _lines(df: DataFrame, section: int, value: Column, query_id: Column | None = None,
           line_no: Column | None = None) -> DataFrame:
    return df.select(F.lit(section).alias("section"),
                     (F.lit(0) if query_id is None else query_id).cast("bigint").alias("query_id"),
                     (F.lit(0) if line_no is None else line_no).cast("bigint").alias("line_no"),
                     value.alias("value"))


def _head(spark: SparkSession, text: str) -> DataFrame:
    return _lines(spark.range(1), HEAD, F.lit(text))


def _stack(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def write_lines(lines: DataFrame, path: str) -> None:
    (lines.orderBy("section", "query_id", "line_no", "value").select("value")
     .write.mode("overwrite").text(path))


def query_texts(topics: DataFrame) -> DataFrame:
    """(query_id, shown): the words of a topic as they are searched."""
    from ranklab.functions.text import tokens
    return topics.select("query_id", F.array_join(tokens(F.col("text")), " ").alias("shown"))


def ranking_report(shown: DataFrame, matches: DataFrame, run: DataFrame, number=decimals) -> DataFrame:
    """Per topic: its words, the number of matching documents, its hits, an empty line."""
    q = F.col("query_id")
    found = shown.join(matches, "query_id", "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    # One scan of the counts gives the three lines that frame a topic's hits.
    frame = found.select("query_id", F.posexplode(F.array(
        F.concat(F.lit("Searching for: "), F.col("shown")),
        F.concat(F.col("n_matches").cast("string"), F.lit(" total matching documents")), F.lit(""))))
    # The empty line goes behind every hit.
    frame = _lines(frame, BODY, F.col("col"), q, F.when(F.col("pos") == 2, F.lit(1 << 40)).otherwise(F.col("pos")))
    hits = _lines(run, BODY, F.concat(
        F.col("rank").cast("string"), F.lit(". Doc ID: "), F.col("doc_id").cast("string"),
        F.lit(" score = "), number(F.col("score"))), q, F.col("rank") + 1)
    return _stack(frame, hits)


def metrics_csv(metrics: DataFrame, means: DataFrame, cut: int, number=decimals) -> DataFrame:
    """`Query I; P@k; R@k; AP@k`, one row per topic, a row of means."""
    row = F.concat_ws("; ", F.concat(F.lit(" "), F.col("query_id").cast("string"), F.lit(" ")),
                      *[number(F.col(m)) for m in ("p", "r", "ap")])
    foot = F.concat_ws(" ; ", F.lit("Promedios: "), *[number(F.col(f"mean_{m}")) for m in ("p", "r", "ap")])
    return _stack(_head(metrics.sparkSession, f"Query I; P@{cut}; R@{cut}; AP@{cut}"),
                  _lines(metrics, BODY, row, F.col("query_id")), _lines(means, FOOT, foot))


def grid_csv(pivot: DataFrame, mean_pivot: DataFrame, metric: str, cut: int,
             lams: Sequence[float] = LAMBDAS, number=decimals) -> DataFrame:
    """Topic x lambda matrix with a row of means; every row ends with a separator."""
    columns = ["l_" + str(x).replace(".", "_") for x in lams]
    cells = F.concat(F.concat_ws(";", *[number(F.col(c)) for c in columns]), F.lit(";"))
    spark = pivot.sparkSession
    return _stack(
        _head(spark, f"{metric}@{cut}"),
        _lines(spark.range(1), HEAD, F.lit("query;" + ";".join(map(str, lams))), line_no=F.lit(1)),
        _lines(pivot, BODY, F.concat(F.col("query_id").cast("string"), F.lit(";"), cells), F.col("query_id")),
        _lines(mean_pivot, FOOT, F.concat(F.lit("Promedio:;"), cells)))


def heldout_csv(best: DataFrame, values: DataFrame, metric: str, cut: int, number=decimals) -> DataFrame:
    """The chosen lambda, one row per held-out topic, their mean."""
    return _stack(
        _lines(best, HEAD, F.concat(F.col("lam").cast("string"), F.lit(f";{metric}@{cut}"))),
        _lines(values, BODY, F.concat_ws(";", F.col("query_id").cast("string"), number(F.col("value"))), F.col("query_id")),
        _lines(values.agg(F.avg("value").alias("mean")), FOOT, F.concat(F.lit("Promedio:;"), number(F.col("mean")))))


def tfidf_eval_csv(values: DataFrame, metric: str, cut: int, number=decimals) -> DataFrame:
    """One row per topic, no row of means."""
    return _stack(
        _head(values.sparkSession, f"{metric}@{cut}"),
        _lines(values, BODY, F.concat_ws(";", F.col("query_id").cast("string"), number(F.col("value"))), F.col("query_id")))


def test_table(tests: DataFrame, by: Sequence[str], number=decimals) -> DataFrame:
    """One line per pair of runs: reject flag and p of the t test, p of the signed-rank test."""
    row = F.concat_ws("\t", *by, F.coalesce(F.col("reject").cast("string"), F.lit("undefined")),
                      number(F.col("p_t")), number(F.col("p_w")))
    head = "\t".join([*by, "Result", "P-value t-test", "P-value Wilcoxon signed-rank test"])
    return _stack(_head(tests.sparkSession, head), _lines(tests, BODY, row))


def ranking_name(collection: str, model: str, cut: int, lam: float, selection: str) -> str:
    """File name from the parameters in use, never from defaults."""
    return f"{collection}.{model}.{cut}.lambda.{lam}.q{selection}.txt"


def metrics_name(collection: str, model: str, cut: int, selection: str) -> str:
    return f"{collection}.{model}.{cut}.q{selection}.csv"


def training_name(collection: str, train: str | None, test: str, metric: str, cut: int, part: str) -> str:
    """`part` is training or test; a TF-IDF evaluation has no training topics (null)."""
    return f"{collection}.jm.training.{train or 'null'}.test.{test}.{metric}{cut}.{part}.csv"

"""Quality rules: fixed limits, and robust multivariate outliers, in built-in functions only.

Per language and source the minimum-covariance-determinant estimate gives mean and
covariance of the most concentrated share of the documents' statistics: from two
starts (all rows; medians and quartile ranges), concentration steps take the share
with the smallest Mahalanobis distances and estimate anew; the start with the smaller
determinant stays. Variances have a floor, since most documents have no symbols or
repetition at all. A document farther out than the chi-square limit is rejected.

A pass moves one partial sum per task and group, never rows; a group of any size is
no hot key. The h-th smallest distance is read from counts of narrow bins of the
distance, so the result does not depend on how rows are dealt out.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from ranklab.session import broadcast_if, keep

SHARE = 0.75                  # of a group's rows that the estimate rests on
STEPS = 4                     # concentration steps
LEAST_ROWS = 60               # smaller groups are judged with the other small ones of their language
REJECT = 1e-3                 # share of normal rows beyond the limit
# name, floor of its standard deviation
STATISTICS = (("log_word_length", 0.10), ("root_symbols", 0.10), ("root_dup_lines", 0.15),
              ("root_repeats", 0.15), ("log_words", 0.70))
P = len(STATISTICS)
PAIRS = list(combinations_with_replacement(range(P), 2))
GROUP = ("g_lang", "g_source")

SPACES = r"[\x20\x09-\x0D]+"


def chi2_cdf(x: float, df: int) -> float:
    """Series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = df / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a))


def chi2_limit(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        low, high = ((low + high) / 2, high) if chi2_cdf((low + high) / 2, df) < p else (low, (low + high) / 2)
    return high


LIMIT = chi2_limit(1 - REJECT, P)
CONSISTENT = SHARE / chi2_cdf(chi2_limit(SHARE, P), P + 2)


def _let(value: Column, use) -> Column:
    """`use(value)`, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in one list of words."""
    def count(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(5)]))

        def among(h: Column) -> Column:
            return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(
                F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered))

        def covered(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
            return _let(F.array_sort(F.transform(twice, lambda x: x["i"])), lambda at: F.aggregate(
                F.transform(at, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(at, k + 1) - x, F.lit(5)))),
                F.lit(0), lambda n, x: n + x))

        return F.when(F.size(w) < 6, 0).otherwise(_let(windows, among))

    return _let(words, count)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the transformed vector).

    One narrow pass over the texts; null texts have no words.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    own = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].cast("string").alias("lang"),
                      docs["source"].cast("string").alias("source"), text.alias("text"),
                      F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = own.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x)).cast("long").alias("n_lines"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).cast("long").alias("n_repeat_words"))
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    vector = (F.log((F.col("word_chars") + 1) / n), F.sqrt(F.col("n_symbols") / n),
              F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n),
              F.log(n))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *[
        v.cast("double").alias(f"x{i}") for i, v in enumerate(vector)])


def _grouped(stats: DataFrame) -> DataFrame:
    """The group each row is judged in: language and source; small ones together by language; what is small still, together.

    Rows that failed the fixed rules have no part in the estimates.
    """
    lang, source = F.coalesce("lang", F.lit("\0null")), F.coalesce("source", F.lit("\0null"))
    rows = stats.select("*", lang.alias("g_lang"), source.alias("g_source"))
    counts = keep(rows.groupBy(*GROUP).agg(F.sum((~F.col("base_failed")).cast("long")).alias("n")))
    small = counts.select(*[F.col(c).alias(f"was{c}") for c in GROUP],
                          F.when(F.col("n") < LEAST_ROWS, "\0rest").otherwise(F.col("g_source")).alias("g_source"), "g_lang", "n")
    again = small.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    named = keep(small.join(again, list(GROUP)).select(
        "wasg_lang", "wasg_source", *[F.when(F.col("total") < LEAST_ROWS, "\0rest").otherwise(F.col(c)).alias(f"to{c}") for c in GROUP]))
    joined = rows.join(broadcast_if(named, named.count() * 200, 8 << 20),
                       (F.col("g_lang") == F.col("wasg_lang")) & (F.col("g_source") == F.col("wasg_source")))
    return joined.select(*stats.columns, *[F.col(f"to{c}").alias(c) for c in GROUP])


def _moments(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Mean and covariance of each group, from sums."""
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(P)], *[
        F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in PAIRS])
    return sums


def _inverted(moments: DataFrame, scale: float) -> DataFrame:
    """Adds the inverse covariance v.. and the log determinant, variances not below their floors (sweep operator)."""
    names = {(i, j): f"v{i}{j}" for i, j in PAIRS}
    at = lambda i, j: F.col(names[min(i, j), max(i, j)])
    floors = [f * f for _, f in STATISTICS]
    out = moments.select("*", F.lit(0.0).alias("logdet"), *[
        (F.col(f"c{i}{j}") * scale + (F.lit(floors[i]) if i == j else F.lit(0.0))).alias(names[i, j]) for i, j in PAIRS])
    for k in range(P):
        rest = [c for c in out.columns if c not in names.values() and c != "logdet"]
        swept = {(i, j): -1 / at(k, k) if i == j == k else at(i, j) / at(k, k) if k in (i, j)
                 else at(i, j) - at(i, k) * at(k, j) / at(k, k) for i, j in PAIRS}
        out = out.select(*rest, (F.col("logdet") + F.log(at(k, k))).alias("logdet"), *[v.alias(names[ij]) for ij, v in swept.items()])
    return out.select(*[c for c in out.columns if c not in names.values()], *[(-F.col(v)).alias(v) for v in names.values()])


def _distance() -> Column:
    total = F.lit(0.0)
    for i, j in PAIRS:
        term = F.col(f"v{i}{j}") * (F.col(f"x{i}") - F.col(f"m{i}")) * (F.col(f"x{j}") - F.col(f"m{j}"))
        total = total + (term if i == j else 2 * term)
    return total


def _with(rows: DataFrame, groups: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows with their group's numbers: broadcast while these are few (measured), else a join that may be split by skew."""
    return rows.join(broadcast_if(groups, groups.count() * 600, 8 << 20), list(keys))


def _starts(rows: DataFrame) -> DataFrame:
    """Two first estimates for each group."""
    plain = _moments(rows, GROUP).withColumn("start", F.lit(0))
    quarters = rows.groupBy(*GROUP).agg(F.count("*").alias("n"), *[
        F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(P)])
    spread = lambda i: ((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349)
    robust = quarters.select(*GROUP, "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(P)], *[
        (spread(i) * spread(i) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS], F.lit(1).alias("start"))
    return plain.unionByName(robust)


def estimates(stats: DataFrame) -> DataFrame:
    """(g_lang, g_source, n, m.., v.., logdet) of each group with at least LEAST_ROWS rows; `stats` as `_grouped` gives them."""
    rows = stats.where("not base_failed").select(*GROUP, *[f"x{i}" for i in range(P)])
    keys = (*GROUP, "start")
    guess = keep(_inverted(_starts(rows).where(F.col("n") >= LEAST_ROWS), 1.0))
    for _ in range(STEPS):
        near = _with(rows, guess.drop("n"), GROUP).select(*keys, *[f"x{i}" for i in range(P)], F.greatest(F.lit(-400), F.least(
            F.lit(4000), F.floor(F.log(_distance() + 1e-9) * 32))).cast("int").alias("bin"))
        counts = near.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
        by = Window.partitionBy(*keys)
        edge = counts.select(*keys, "bin", F.sum("n").over(by.orderBy("bin")).alias("up"), F.sum("n").over(by).alias("all")).where(
            F.col("up") >= F.col("all") * SHARE).groupBy(*keys).agg(F.min("bin").alias("edge"))
        inner = _with(near, keep(edge), keys).where(F.col("bin") <= F.col("edge"))
        guess = keep(_inverted(_moments(inner, keys), CONSISTENT))
    best = guess.groupBy(*GROUP).agg(F.min(F.struct("logdet", "start")).alias("best"))
    return keep(guess.join(best, list(GROUP)).where(F.col("start") == F.col("best.start")).drop("best", "start"))


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept), a row for each of `docs`.

    base_failed: under 10 words, or over 20 % of them in repeated 5-word windows. kept: not
    base_failed and the squared Mahalanobis distance within the limit. Null languages and
    sources are groups of their own; where even all small groups together have fewer than
    LEAST_ROWS rows there is no estimate: distance is null, and the fixed rules decide alone.
    Repeated rows count each; an empty table gives no rows; other columns are not read.
    """
    stats = keep(_grouped(keep(statistics(docs))))
    groups = estimates(stats)
    judged = stats.join(broadcast_if(groups.drop("n"), groups.count() * 600, 8 << 20), list(GROUP), "left")
    distance = _distance()
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         distance.alias("distance"), (~F.col("base_failed") & F.coalesce(distance <= LIMIT, F.lit(True))).alias("kept"))

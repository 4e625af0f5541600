"""URL filters as a sort-merge range join over reversed hosts, in built-in functions only.

A host is keyed by its labels from the right, each followed by a dot, so that a
rule's host and all its subdomains are one interval of keys. Intervals of rules
nest or are disjoint. Where one begins or ends, the stack of active rules changes;
these boundaries and the distinct hosts are sorted together by key ranges, and a
sweep over each range carries the last boundary's stack to the hosts behind it.
A range starts with the stack that the ranges before it left. The paths of the few
rules on a host's stack are compared last; the longest rule that fits wins.

Hosts are made distinct before anything is shuffled, so a host that holds a
third of all pages is one row of the sweep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ranklab.session import BROADCAST_BYTES, broadcast_if, keep

# The base rules.
BASE_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
              ("com", "/fr/", "allow"), ("com", "/de/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """`www.example.org` -> `org.example.www.`"""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def base_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BASE_RULES, "host string, path string, verdict string")


def boundaries(rules: DataFrame) -> DataFrame:
    """(key, stack): where a rule host's interval begins, with all rules active in it; where it ends, with those around it."""
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null").distinct()
    hosts = rules.select("host").distinct()
    labels = F.split("host", r"\.")
    around = hosts.select(F.col("host").alias("at"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."))).alias("host"))
    nested = around.join(rules, "host").groupBy("at").agg(F.sort_array(F.collect_list(
        F.struct("host", "path", "verdict"))).alias("stack"))          # rules on a host and above it: as many as labels nest
    begin = nested.select(key_of(F.col("at")).alias("key"), "stack")
    end = nested.select(F.concat(F.regexp_replace(key_of(F.col("at")), r"\.$", "/")).alias("key"),
                        F.filter("stack", lambda r: r["host"] != F.col("at")).alias("stack"))
    return begin.unionByName(end)


def sweep(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, stack): the rules whose interval holds the host."""
    events = boundaries(rules).select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), "stack")
    points = hosts.select(key_of(F.col("host")).alias("key"), F.lit(1).alias("kind"), "host",
                          F.lit(None).cast(events.schema["stack"].dataType).alias("stack"))
    ranges = keep(events.unionByName(points).repartitionByRange("key", "kind").withColumn("range", F.spark_partition_id()))
    last = ranges.groupBy("range").agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
    carried = last.select("range", F.last("last", ignorenulls=True).over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))   # a row for each range
    order = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ranges.join(F.broadcast(carried), "range").select(
        "kind", "host", F.coalesce(F.last("stack", ignorenulls=True).over(order), F.col("carried")).alias("stack"))
    return swept.where("kind = 1 and size(stack) > 0").select("host", "stack")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest
    rule (host and path together) wins; of equally long ones that with the longer host, then
    `block`. No rule: rule is null and the verdict is `default`. A null url or one without ://
    has empty host and path. Repeated rows are judged each. Rules with a null host or path
    are no rules; an empty table of rules or pages is no special case.
    """
    own = pages.select(pages["page_id"].alias("page_id"), host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    hosts = own.select("host").where("host != ''").distinct()
    found = keep(sweep(hosts, rules))
    size = found.agg(F.coalesce(F.sum(F.length("host") + 64 * F.size("stack") + 32), F.lit(0)).alias("n")).first()["n"]
    active = own.join(broadcast_if(found, size, BROADCAST_BYTES // 4), "host", "left")
    fitting = F.transform(F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"])), lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("n"), F.length(r["host"]).alias("h"), r["verdict"].alias("verdict"),
        F.concat(r["host"], r["path"]).alias("rule")))
    return active.select("page_id", "host", "path", F.array_max(fitting).alias("best")).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))

"""Where shared files go, and how large a side may be to be broadcast."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A side of a join is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Number of salts spread over one join key when a side is too large to broadcast.
JOIN_SALTS = 32


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="ranklab-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/ranklab-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for one statement; what was there before comes back."""
    named = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def table_name(place: str) -> str:
    return f"ranklab_rows_{hashlib.sha256(place.encode()).hexdigest()[:24]}"


def bucketed_table(spark: SparkSession, name: str, place: str, schema: str, key: str, order: str, buckets: int) -> DataFrame:
    """Files partitioned by `part` and bucketed by `key`, by a table name, which is how Spark learns of their bucketing."""
    if not spark.catalog.tableExists(name):
        place = place.replace("\\", "\\\\").replace("'", "\\'")
        most = max(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
        # folders are found by listing, so that another application's parts and batches are seen
        with settings(spark, sources__bucketing__maxBuckets=str(most), hive__manageFilesourcePartitions="false"):
            spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (part) "
                      f"CLUSTERED BY ({key}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, from file sizes; no job runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition by `key` when the input is too small to give every core a split.

    A large table is left alone: no shuffle is spent on it.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(cores, key) if estimated_bytes(df) < cores * split else df


def keep(df: DataFrame) -> DataFrame:
    """Store a small result that is used more than once, in the shared folder.

    What was computed survives lost executors and is not computed again per use.
    """
    path = f"{shared_folder(df.sparkSession)}/kept"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: str, small_bytes: int,
               salt_by: str = "row_id", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of a large side with one of known size.

    Below `limit` the small side is broadcast and the large side stays where it
    is. Above, both are shuffled on (key, salt), so that a key that holds a
    large part of all rows is split over JOIN_SALTS tasks.
    """
    if small_bytes <= limit:
        return big.join(F.broadcast(small), on)
    salted = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(JOIN_SALTS - 1))))
    return (big.withColumn("salt", F.pmod(F.xxhash64(salt_by), F.lit(JOIN_SALTS)).cast("int"))
            .join(salted, [on, "salt"]).drop("salt"))


def broadcast_if(df: DataFrame, n_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The broadcast hint, given only when the known size allows it."""
    return F.broadcast(df) if n_bytes <= limit else df


def scalar(df: DataFrame, expression: Column) -> Column:
    """One aggregate of a table as a scalar subquery, evaluated by Spark, not by the driver."""
    return df.select(expression.alias("v")).scalar()

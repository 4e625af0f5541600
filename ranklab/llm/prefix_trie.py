"""The trie of all conversations' turn sequences, one row per node.

Conversations are sorted by their paths (the digests of their turns) and cut by key ranges
into shards of about equal size. A shard writes its part of the trie as balanced
parentheses, in which the least excess of every block is kept in two levels (range min-max
blocks): findclose gives the end of a node's subtree, the rank of "()" pairs its leaves, and
differences of cumulative arrays its members and savings.

Only nodes on a shard's first and last path (its spines) can go on in another shard. Their
rows are merged over the shards. What two neighbours count twice is a chain of nodes, from
the root to the last common one; each boundary between shards takes it back by one row per
node of that chain, with sums along the chain, so merging is linear in the spines. A first
turn, a conversation or a set of copies of any size is cut like any other range: the sort
key ends in the conversation's id. Member lists longer than a shard are hashed piece by piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ranklab.llm.common import take
from ranklab.session import keep

BLOCK = 256             # parentheses in a block, and blocks in a block of the second level
SHARD_TURNS = 250_000   # turns that a shard holds, about
CHUNK_IDS = 10_000      # ids in a piece of a member list
DIGEST = 32             # characters of a turn's digest
INNER, EDGE, CHUNK = 0, 1, 2

_SHARD = (
    "kind int, shard int, opening boolean, closing boolean, key binary, parent_key binary, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, bytes long, path_bytes long, "
    "last_depth long, seq long, ends string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Parentheses:
    """A tree as balanced parentheses: findclose by blocks' least excess, rank of leaf pairs."""

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1))
        self.least = np.minimum.reduceat(self.excess, np.arange(0, len(opens), BLOCK))
        self.wide = np.minimum.reduceat(self.least, np.arange(0, len(self.least), BLOCK))
        self.pairs = np.concatenate(([0], np.cumsum(opens[:-1] & ~opens[1:]), [0]))   # leaves that open before a place
        self.pairs[-1] = self.pairs[-2]

    def findclose(self, at: int) -> int:
        """Place of the parenthesis that closes the one opened at `at`."""
        below = self.excess[at] - 1
        block = at // BLOCK
        inside = self._first(self.excess, at + 1, min(len(self.excess), (block + 1) * BLOCK), below)
        if inside >= 0:
            return inside
        group = (block + 1) // BLOCK
        found = self._first(self.least, block + 1, min(len(self.least), (group + 1) * BLOCK), below)
        if found < 0:
            group = self._first(self.wide, group + 1, len(self.wide), below)
            found = self._first(self.least, group * BLOCK, min(len(self.least), (group + 1) * BLOCK), below)
        return self._first(self.excess, found * BLOCK, min(len(self.excess), (found + 1) * BLOCK), below)

    @staticmethod
    def _first(values: np.ndarray, start: int, stop: int, limit: int) -> int:
        reached = values[start:stop] <= limit
        n = int(reached.argmax()) if stop > start else 0
        return start + n if stop > start and reached[n] else -1

    def leaves(self, at: int, close: int) -> int:
        return int(self.pairs[close] - self.pairs[at])


class Shard:
    """Sorted paths become parentheses and one entry per node, in the order in which nodes open."""

    def __init__(self) -> None:
        self.opens = bytearray()
        self.parent, self.depth, self.bytes, self.children, self.least, self.ends = [], [], [], [], [], []
        self.ids: dict[int, list[int]] = {}
        self.stack: list[int] = []
        self.path, self.first_path = "", None

    def _open(self, n_bytes: int) -> None:
        if self.stack:
            self.children[self.stack[-1]] += 1
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.depth.append(len(self.stack))
        self.bytes.append(n_bytes)
        self.children.append(0)
        self.least.append(None)
        self.ends.append(0)
        self.stack.append(len(self.parent) - 1)
        self.opens.append(1)

    def _close(self) -> None:
        node = self.stack.pop()
        if self.stack:
            up = self.stack[-1]
            if self.least[up] is None or self.least[node] < self.least[up]:
                self.least[up] = self.least[node]
        self.opens.append(0)

    def add(self, conv_id: int, path: str, sizes: list[int]) -> None:
        if self.first_path is None:
            self.first_path = path
            self._open(0)
        shorter = min(len(path), len(self.path))
        common = 0
        if path.startswith(self.path):
            common = shorter // DIGEST
        while common * DIGEST < shorter and path[common * DIGEST:(common + 1) * DIGEST] == self.path[common * DIGEST:(common + 1) * DIGEST]:
            common += 1
        while len(self.stack) > common + 1:
            self._close()
        for n in range(common, len(path) // DIGEST):
            self._open(sizes[n])
        node = self.stack[-1]
        self.ends[node] += 1
        self.ids.setdefault(node, []).append(conv_id)
        if self.least[node] is None or conv_id < self.least[node]:
            self.least[node] = conv_id
        self.path = path

    def rows(self, shard: int) -> Iterator[dict]:
        """All rows of the shard: inner nodes, nodes of the two spines, and pieces of these nodes' member lists."""
        if self.first_path is None:
            return
        last = list(self.stack)
        while self.stack:
            self._close()
        opens = np.frombuffer(self.opens, np.uint8).astype(bool)
        tree = Parentheses(opens)
        places = np.flatnonzero(opens)
        members = np.concatenate(([0], np.cumsum(self.ends)))
        closes = [tree.findclose(at) for at in places.tolist()]
        size = [(close - at + 1) // 2 for at, close in zip(places.tolist(), closes)]
        n_convs = [int(members[i + s] - members[i]) for i, s in enumerate(size)]
        saved = np.concatenate(([0], np.cumsum([(n - 1) * b for n, b in zip(n_convs, self.bytes)])))
        first = list(range(len(self.first_path) // DIGEST + 1))
        keys = dict(zip(first, spine(self.first_path))) | dict(zip(last, spine(self.path)))
        along = {}                                          # bytes from the root to a node of a spine
        for node in [*first, *last]:
            along[node] = along.get(self.parent[node], 0) + self.bytes[node]
        firsts, lasts = set(first), set(last)
        for node, (at, close) in enumerate(zip(places.tolist(), closes)):
            up, key = self.parent[node], keys.get(node)
            row = {"shard": shard, "depth": self.depth[node], "conv_id": self.least[node], "n_convs": n_convs[node],
                   "n_children": self.children[node], "n_leaves": tree.leaves(at, close), "parent_key": keys.get(up),
                   "saved_tokens": int(saved[node + size[node]] - saved[node])}
            ids = self.ids.get(node, ())
            if key is None:
                ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
                yield row | {"kind": INNER, "ends": ends, "parent_conv_id": None if up in keys else self.least[up]}
                continue
            yield row | {"kind": EDGE, "key": key, "opening": node in firsts, "closing": node in lasts, "bytes": self.bytes[node],
                         "path_bytes": along[node], "last_depth": len(last) - 1}
            for n in range(0, len(ids), CHUNK_IDS):
                yield {"kind": CHUNK, "shard": shard, "key": key, "seq": n, "ends": ",".join(map(str, ids[n:n + CHUNK_IDS]))}


def spine(path: str) -> Iterator[bytes]:
    """Keys of the nodes on a path, the root first: each is a digest of the one above and the turn."""
    key = hashlib.blake2b(b"", digest_size=16).digest()
    yield key
    for n in range(0, len(path), DIGEST):
        key = hashlib.blake2b(key + path[n:n + DIGEST].encode(), digest_size=16).digest()
        yield key


def rebuilt(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, path, sizes): every conversation with the head of the first one of its family.

    With h = crc32(decimal conv_id) % `most`, conversation c has the first h turns of
    c - c % `family` (fewer if there are fewer), then its own after its first h. `path` is the
    turns' digests in a row, `sizes` the UTF-8 bytes of their texts. Only digests are moved.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = take(conversations, conv_id=conversations["conv_id"].cast("long"), turn="turn", role="role", text="text").where("conv_id is not null")
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")))).alias("turns"))
    turns = turns.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))))
    heads = turns.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    base = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    both = turns.select("conv_id", "turns", h.alias("h"), base).join(heads, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", 1, F.col("h")))
    return both.select("conv_id", F.concat(head, own).alias("t")).select(
        "conv_id", F.array_join("t.digest", "").alias("path"), F.col("t.bytes").alias("sizes"))


def nodes(paths: DataFrame) -> DataFrame:
    """One row per distinct beginning of the sequences in `paths` (conv_id, path, sizes), the empty one included.

    conv_id: smallest member; parent_conv_id: the parent's (root: null); n_convs, n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (bytes of the subtree's last texts,
    each as often as it has members but one), ends_sha256 (of the ids of conversations that end
    here). conv_id is unique and not null. No conversations: no rows.
    """
    spark = paths.sparkSession
    paths = keep(paths)
    turns = paths.agg(F.sum(F.size("sizes") + 1).alias("n")).first()["n"] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-int(turns) // SHARD_TURNS))
    ordered = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")

    kind = T.StructType.fromDDL(_SHARD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                shard.add(*row)
        yield from _batches(shard.rows(TaskContext.get().partitionId()), kind)

    told = keep(ordered.mapInArrow(run, kind))
    edges, inner = told.where(F.col("kind") == EDGE), told.where(F.col("kind") == INNER)
    merged = keep(_merged(edges))
    chunks = told.where(F.col("kind") == CHUNK).select("key", "shard", "seq", "ends")
    up = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    none = hashlib.sha256(b"").hexdigest()
    spines = merged.join(_hashed(chunks), "key", "left").join(up, "parent_key", "left").select(
        "conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
    # a spine's nodes are known by shard, so that the children of one node, however many, are joined shard by shard
    known = edges.select("shard", F.col("key").alias("parent_key")).join(up, "parent_key")
    low = inner.where("parent_key is null").select("*", F.lit(None).cast("long").alias("up")).unionByName(
        inner.where("parent_key is not null").join(known, ["shard", "parent_key"]))
    low = low.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up")).withColumn("ends_sha256", F.col("ends"))
    return spines.unionByName(low.select(*NODE)).select(*NODE)


def _merged(edges: DataFrame) -> DataFrame:
    """One row per node of a spine: sums over the shards, less what neighbours have both counted."""
    spark = edges.sparkSession
    shards = sorted(r["shard"] for r in edges.where("opening and depth = 0").select("shard").collect())   # one number per task
    following = spark.createDataFrame(list(zip(shards, shards[1:])), "shard int, after int")
    left = edges.where("closing").select("shard", "key", "depth", "bytes", "path_bytes", "last_depth")
    right = edges.where("opening").select(F.col("shard").alias("after"), "key")
    chain = left.join(F.broadcast(following), "shard").join(right, ["after", "key"])
    reach = chain.groupBy("shard").agg(F.max("depth").alias("reach"), F.max("path_bytes").alias("reach_bytes"))
    twice = chain.join(reach, "shard").select(
        "key", F.when(F.col("depth") < F.col("reach"), -1).otherwise(0).cast("long").alias("n_children"),
        F.when(F.col("last_depth") == F.col("reach"), -1).otherwise(0).cast("long").alias("n_leaves"),
        (F.col("reach_bytes") - F.col("path_bytes") + F.col("bytes")).alias("saved_tokens"))
    own = edges.select("key", "n_children", "n_leaves", "saved_tokens", "depth", "parent_key", "conv_id", "n_convs")
    both = own.unionByName(twice, allowMissingColumns=True)
    return both.groupBy("key").agg(F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
                                   *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])


def _hashed(chunks: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the pieces of member lists, one piece after the other."""
    kind = T.StructType.fromDDL("key binary, ends_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            key, hasher = None, None
            for batch in batches:
                for own, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                    if own != key:
                        if hasher:
                            yield {"key": key, "ends_sha256": hasher.hexdigest()}
                        key, hasher = own, hashlib.sha256()
                    else:
                        hasher.update(b",")
                    hasher.update(text.encode())
            if hasher:
                yield {"key": key, "ends_sha256": hasher.hexdigest()}

        yield from _batches(rows(), kind)

    return chunks.repartition("key").sortWithinPartitions("key", "shard", "seq").mapInArrow(run, kind)


def _batches(rows: Iterator[dict], kind: T.StructType, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    arrow, held = to_arrow_schema(kind), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations; see `rebuilt` and `nodes`.

    Turns are in the order of turn (null first), those of one turn by role and digest; a null
    role or text is empty, repeated rows are turns of their own. Rows without conv_id belong to
    no conversation and are left out. A conversation whose rebuilt sequence is empty ends at the
    root. Texts of any length count as digests; other columns are not read. No rows: no nodes.
    A conversation's digests are one row, of 60 bytes a turn.
    """
    return nodes(rebuilt(conversations))

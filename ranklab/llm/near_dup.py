"""Near-duplicate documents by Order MinHash and banded alignment of their words.

A document is the sequence of its words; for candidates, the sequence of its 3-word
shingles, each labelled with how often it has occurred before. For each of several hash
functions the sketch keeps the three labelled shingles with the smallest hashes in text order
(Marcais et al. 2019), so that two documents meet in a bucket when these agree in content and
in order. Candidates are verified by aligning their words inside the band that the
similarity allows: similarity = aligned / (words of both - aligned), where aligned is the
longest common subsequence. Two texts whose 5-word shingles are similar by 0.8 are so by
their words, too; the reverse does not hold (one changed word costs five shingles).

Hot groups never become pairs of all with all:
* texts with the same words are one node from the start, by a partial aggregate;
* in a bucket every node is compared with one representative, its hub, and what is similar
  leaves the bucket as a component. The first hash functions go first, so that most members of
  a large group are known to belong together before the others are looked at;
* of a small bucket (at most SMALL_BUCKET nodes) all pairs of different components are compared;
* of a larger bucket all pairs of different components are looked at, too, in tiles of TILE nodes: the
  words of each node are counted in 64, then 1024 bins, and two texts whose bins differ by more words than the
  similarity leaves over cannot be similar. Pairs that this bound leaves open are aligned in the tile, unless links
  found there connect them already; only links leave it. Members of the hub's component are never paired with one
  another, nor texts whose lengths are too different.

So every pair that shares a bucket is compared, or known to be in one class, or told apart by a bound.

Joins go over the node's 128-bit hash; a hub's join key is split by Spark's skew join. All
tables that are used twice are written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, words
from ranklab.session import broadcast_if, keep

SHINGLE = 3          # words in a shingle of the sketch
SIMILAR = 0.8
TUPLE = 3            # shingles in one hash value of a sketch
MISS = 1e-2          # chance that two documents at the limit share no bucket
LEADING = 3          # hash functions that are looked at first
SMALL_BUCKET = 12    # buckets up to this size align all members of different components
TILE = 1024          # nodes of a larger bucket, about, that one group compares with as many others
BINS, COARSE = 1024, 64     # numbers of words are counted in COARSE bins first, then in BINS
BROADCAST_BYTES = 8 << 20
HELD_WORDS = 2_000_000      # of documents that a task keeps ready while it compares, about

_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def bands(similar: float = SIMILAR, size: int = TUPLE, miss: float = MISS) -> int:
    """How many hash functions make a miss as unlikely as `miss`, for changed words all over the text."""
    same = (2 * similar / (1 + similar)) ** SHINGLE          # share of a text's shingles that hold no changed word
    return math.ceil(math.log(miss) / math.log(1 - (same / (2 - same)) ** size))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def labelled_shingles(codes: np.ndarray) -> np.ndarray:
    """64-bit numbers of the shingles in text order, the n-th occurrence of one shingle having a number of its own."""
    n = max(1, len(codes) - SHINGLE + 1)
    codes = codes.astype(np.uint64)
    out = np.full(n, len(codes) if len(codes) < SHINGLE else SHINGLE, np.uint64)
    for i in range(min(SHINGLE, len(codes))):
        out = _mix(out * _MIX[0] + codes[i:i + n])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    if not fresh.all():
        at = np.arange(n)
        seen = np.empty(n, np.uint64)
        seen[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
        out = np.where(seen > 0, _mix(out + seen * _MIX[0]), out)
    return out


def sketch(shingles: np.ndarray, count: int, size: int = TUPLE) -> np.ndarray:
    """One number for each hash function: the `size` smallest labelled shingles in text order."""
    seeds = _mix(np.arange(1, count + 1, dtype=np.uint64) * _MIX[0])
    hashes = _mix(shingles[None, :] ^ seeds[:, None])
    if size < len(shingles):
        own = np.sort(np.argpartition(hashes, size - 1, axis=1)[:, :size], axis=1)
    else:
        own = np.broadcast_to(np.arange(len(shingles)), hashes.shape)
    for j in range(own.shape[1]):
        seeds = _mix(seeds * _MIX[0] + shingles[own[:, j]])
    return seeds.view(np.int64)


class Shape:
    """A text's words as numbers: in order, and counted."""

    __slots__ = ("words", "kinds", "counts", "_places")

    def __init__(self, codes: np.ndarray):
        self.words = codes.tolist()
        self.kinds, self.counts = np.unique(codes, return_counts=True)
        self._places: dict[int, int] | None = None

    def places(self) -> dict[int, int]:
        """The places of each word, as bits."""
        if self._places is None:
            self._places = {}
            for n, c in enumerate(self.words):
                self._places[c] = self._places.get(c, 0) | 1 << n
        return self._places

    def shared(self, other: Shape) -> int:
        """Words in common, in any order."""
        at = np.minimum(np.searchsorted(other.kinds, self.kinds), len(other.kinds) - 1)
        same = other.kinds[at] == self.kinds
        return int(np.minimum(self.counts[same], other.counts[at[same]]).sum())


def aligned(a: Shape, b: Shape, far: int) -> int:
    """Longest common subsequence with places at most `far` apart, one row of the table at a time.

    A row is the columns inside the band, as bits: 0 where the length grows by one from a
    column to the next. Columns that the band has left are counted.
    """
    places, m, full = b.places(), len(b.words), (1 << 2 * far + 1) - 1
    high = min(m, far)                                       # columns below this are in
    row, low, gone = (1 << high) - 1, 0, 0
    for i, c in enumerate(a.words):
        if i > far:
            if low >= m:
                break
            gone += ~row & 1
            row >>= 1
            low += 1
        if high < m:
            row |= 1 << high - low
            high += 1
        if c in places:
            met = row & places[c] >> low & full
            row = (row + met | row ^ met) & (1 << high - low) - 1
    return gone + (high - low) - row.bit_count()


def similarity(a: Shape, b: Shape, similar: float = SIMILAR) -> float:
    """Aligned share of two texts' words; 0 where it is below `similar`."""
    total = len(a.words) + len(b.words)
    least = math.ceil(similar * total / (1 + similar) - 1e-9)        # aligned words that are needed
    if min(len(a.words), len(b.words)) < least or a.shared(b) < least:
        return 0.0
    n = aligned(a, b, total - 2 * least)                             # no more words than that are left over
    return n / (total - n) if n >= least else 0.0


def _codes(own: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, own), np.uint32, len(own))


def _pointer(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes of id and text that find the row again."""
    return [F.xxhash64(doc_id, text).alias("p1"), F.hash(text, doc_id).alias("p2")]


def sketched(docs: DataFrame, count: int) -> DataFrame:
    """(doc_id, p1, p2, node, size, keys): a key for each hash function. node: 128-bit hash of the words, of the text itself where it has none."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), *_pointer(docs["doc_id"], docs["text"]), docs["text"].alias("text"))
    schema = T.StructType(list(rows.schema.fields)[:3]).add("node", "binary").add("size", "long").add("keys", T.ArrayType(T.LongType()))

    def work(batch: pa.RecordBatch) -> dict:
        nodes, sizes, keys = [], [], []
        for text in batch.column(3).to_pylist():
            own = words(text)
            nodes.append(hashlib.blake2b(b" ".join(own) if own else b"\n" + (text or "").encode(), digest_size=16).digest())
            sizes.append(len(own))
            keys.append(sketch(labelled_shingles(_codes(own)), count).tolist() if own else [])
        return {"doc_id": batch.column(0), "p1": batch.column(1), "p2": batch.column(2), "node": nodes, "size": sizes, "keys": keys}

    return map_batches(rows, work, schema)


def _similar(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (hub, node) that are similar. `texts`: node, codes. A task meets the pairs of one hub one after the other."""
    hub = texts.select(F.col("node").alias("hub"), F.col("codes").alias("codes_hub"))
    both = pairs.join(texts.select("node", "codes"), "node").join(hub, "hub").select("hub", "node", "codes_hub", "codes")
    schema = T.StructType(list(both.schema.fields)[:2])

    def work(batch: pa.RecordBatch) -> dict:
        made: dict[bytes, Shape] = {}
        held = 0
        out = []
        for hub, own_hub, own in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
            if hub not in made:
                if held > HELD_WORDS:
                    made.clear()
                    held = 0
                made[hub] = Shape(np.frombuffer(own_hub.as_py(), np.uint32))
                held += len(made[hub].words)
            out.append(similarity(Shape(np.frombuffer(own.as_py(), np.uint32)), made[hub], similar) > 0)
        keep_ = pa.array(out, pa.bool_())
        return {"hub": batch.column(0).filter(keep_), "node": batch.column(1).filter(keep_)}

    return map_batches(both, work, schema)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes in `links` (a, b): the smallest node each is connected with.

    In each round a node takes the smallest label among its neighbours' and its label's own label.
    """
    both = keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = keep(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        moved = keep(stepped.join(jump, "next", "left").select("node", "label", F.least("next", "jumped").alias("next")))
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("label != next").isEmpty():
            return moved.select("node", F.col("next").alias("component"))


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, p1, p2, node, class_id, first): a row for every row of `docs`.

    Rows of one class are connected by links of at least `similar`; class_id is the class's
    smallest doc_id (null if all are null) and `first` marks the row that stands for it (the
    smallest id, then hash; repeated rows with that id and text are all marked). Texts without
    words, null ones included, are equal only if their texts are; null counts as empty.
    An empty table gives no rows; other columns are not read; texts of any length are read whole.
    """
    rows = keep(sketched(docs, bands(similar)))
    nodes = keep(rows.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nulls"), "doc_id", "p1", "p2")).alias("first"),
        F.first("size").alias("size"), F.first("keys").alias("keys")))
    members = nodes.select("node", "size", F.posexplode("keys").alias("band", "bucket"))
    met = keep(_buckets(members))                            # only nodes that share a bucket with another go on
    texts = _texts(docs, nodes, met)
    found = keep(met.select("node", F.col("node").alias("component")).limit(0))
    for some in (met.where(F.col("band") < LEADING), met.where(F.col("band") >= LEADING)):
        found = _joined(found, _links(_apart(_stars(some, similar), found), texts, similar))
    small = _left(met, found).where(F.col("n") <= SMALL_BUCKET)
    found = _joined(found, _links(_apart(_all_pairs(small, similar), found), texts, similar))
    large = keep(_left(met.where(F.col("n") > SMALL_BUCKET), found))
    if not large.isEmpty():
        found = _joined(found, _tiled_links(large, texts, similar))
    return _told(rows, nodes, found)


def _buckets(members: DataFrame) -> DataFrame:
    """`members` (node, size, band, bucket) of buckets with several, with their number n and the hub: (hub, hub_size).

    The hub is the node with the smallest hash.
    """
    rank = F.xxhash64("node")
    shared = keep(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min(rank).alias("rank")).where("n > 1"))
    met = keep(members.join(broadcast_if(shared, 32 * shared.count(), BROADCAST_BYTES), "bucket"))
    hubs = met.where(rank == F.col("rank")).select("bucket", F.col("node").alias("hub"), F.col("size").alias("hub_size"))
    return met.drop("rank").join(hubs, "bucket")


def _alike(similar: float) -> Column:
    return F.least("size", "hub_size") >= similar * F.greatest("size", "hub_size")


def _stars(met: DataFrame, similar: float) -> DataFrame:
    """Each node with the hub of each of its buckets, (hub, node)."""
    return met.where((F.col("node") != F.col("hub")) & _alike(similar)).select("hub", "node").distinct()


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose two nodes are not yet known to belong together."""
    names = [found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("hub", "node")]
    both = pairs.join(names[0], "hub", "left").join(names[1], "node", "left")
    return both.where(F.coalesce("hub_in", "hub") != F.coalesce("node_in", "node")).select("hub", "node")


def _links(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    return keep(_similar(pairs, texts, similar).select(F.col("hub").alias("a"), F.col("node").alias("b")))


def _left(met: DataFrame, found: DataFrame) -> DataFrame:
    """`met` with components, without buckets that are in one component."""
    own = met.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hubs = found.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    own = own.join(hubs, "hub", "left").withColumn("hub_component", F.coalesce("hub_component", "hub"))
    mixed = own.where("component != hub_component").select("bucket").distinct()
    return own.join(mixed, "bucket", "left_semi")


def _all_pairs(small: DataFrame, similar: float) -> DataFrame:
    """(hub, node): pairs of different components of one bucket; pairs with the bucket's hub have been compared."""
    own = small.where("node != hub").select("bucket", "node", "size", "component")
    other = own.select("bucket", F.col("node").alias("other"), F.col("size").alias("hub_size"), F.col("component").alias("other_in"))
    pairs = own.join(other, "bucket").where((F.col("other") < F.col("node")) & (F.col("component") != F.col("other_in")) & _alike(similar))
    return pairs.select(F.col("other").alias("hub"), "node").distinct()


def _tiled_links(large: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """(a, b): links between similar texts of one bucket, as many as connect what the bucket's pairs connect.

    A bucket of more than TILE nodes is cut into cells: the hub's component apart, by length, then by hash. Two
    cells are compared where they can hold similar texts of different components; a group is two cells. A pair is
    looked at in the first of the buckets it shares only, aligned where the numbers of its words leave it open, and
    passed over once links of its group connect it. So a group gives fewer links than it has nodes.
    """
    step = max(1.001 * math.log(1 / similar), 1e-6)     # lengths of similar texts are in one class or in neighbouring ones
    whole = F.col("n") <= TILE
    cut = large.select("bucket", "band", "node", "component", whole.alias("whole"),
                       (~whole & (F.col("component") == F.col("hub_component"))).alias("inside"),
                       F.when(whole, 0).otherwise(F.floor(F.log("size") / step)).cast("int").alias("length"))
    parts = cut.groupBy("bucket", "inside", "length", "whole").agg(F.count("*").alias("in_cell")).select(
        "bucket", "inside", "length", F.when(F.col("whole"), 1).otherwise(F.ceil(F.col("in_cell") / TILE)).cast("int").alias("chunks"))
    cells = parts.select("bucket", "inside", "length", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    cell = F.struct("inside", "length", "chunk")
    one, two = cells.select("bucket", cell.alias("a")), cells.select("bucket", cell.alias("b"))
    tiles = one.join(two, "bucket").where((F.col("a") <= F.col("b")) & (F.abs(F.col("a.length") - F.col("b.length")) <= 1)
                                          & ~(F.col("a.inside") & F.col("b.inside")))
    tile = F.struct("a", "b").alias("tile")
    sides = tiles.select("bucket", "a.*", tile, F.lit(0).alias("side")).unionByName(
        tiles.where("a != b").select("bucket", "b.*", tile, F.lit(1).alias("side")))
    own = texts.join(large.groupBy("node").agg(F.collect_list(F.struct("band", "bucket")).alias("places")), "node").select(
        "node", "codes", F.col("places.band").alias("bands"), F.col("places.bucket").alias("buckets"))
    rows = cut.join(parts, ["bucket", "inside", "length"]).withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    rows = rows.join(own, "node").join(sides, ["bucket", "inside", "length", "chunk"]).select(
        "bucket", "band", "tile", "side", "node", "component", "codes", "bands", "buckets")
    count = bands(similar)

    def work(group: pa.Table) -> pa.Table:
        nodes, band = group["node"].to_pylist(), group["band"][0].as_py()
        numbers: dict[bytes, int] = {}
        inside = np.fromiter((numbers.setdefault(c, len(numbers)) for c in group["component"].to_pylist()), np.int64, len(nodes))
        codes = [np.frombuffer(c, np.uint32) for c in group["codes"].to_pylist()]
        sizes = np.fromiter(map(len, codes), np.int64, len(nodes))
        fine = np.array([np.minimum(np.bincount(c % BINS, minlength=BINS), 65535) for c in codes], np.int32)
        coarse = fine.reshape(len(nodes), -1, COARSE).sum(axis=1)
        met, place = np.zeros((len(nodes), count), bool), np.zeros((len(nodes), count), np.int64)
        for i, (b, p) in enumerate(zip(group["bands"].to_pylist(), group["buckets"].to_pylist())):
            met[i, b], place[i, b] = True, p
        met, place = met[:, :band], place[:, :band]             # buckets in which a pair is looked at before
        side = group["side"].to_numpy()
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1) if (side == 1).any() else None
        shapes: dict[int, Shape] = {}
        held, found = 0, []

        def shape(i: int) -> Shape:
            nonlocal held
            if i not in shapes:
                if held > HELD_WORDS:
                    shapes.clear()
                    held = 0
                shapes[i] = Shape(codes[i])
                held += len(codes[i])
            return shapes[i]

        for n, i in enumerate(first):
            others = first[n + 1:] if second is None else second
            total = sizes[i] + sizes[others]
            least = np.ceil(similar * total / (1 + similar) - 1e-9)
            near = (np.minimum(sizes[i], sizes[others]) >= least) & (inside[others] != inside[i])
            others, far = others[near], (total - 2 * least)[near]
            for counts in (coarse, fine):
                near = np.abs(counts[others] - counts[i]).sum(axis=1) <= far
                others, far = others[near], far[near]
            others = others[~((place[others] == place[i]) & met[others] & met[i]).any(axis=1)]
            if not len(others):
                continue
            own_shape = shape(i)
            for j in others:
                if inside[j] != inside[i] and similarity(shape(j), own_shape, similar) > 0:
                    found.append((nodes[i], nodes[j]))
                    inside[inside == inside[j]] = inside[i]
            own_shape._places = None
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return keep(rows.groupBy("bucket", "tile").applyInArrow(work, "a binary, b binary"))


def _joined(found: DataFrame, fresh: DataFrame) -> DataFrame:
    """Components (node, component) after more links (a, b), from the graph of the components that these connect."""
    if fresh.isEmpty():
        return found
    ends = fresh.select(F.col("a").alias("node")).union(fresh.select(F.col("b").alias("node"))).distinct()
    all_ = found.unionByName(ends.join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
    names = [all_.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in "ab"]
    between = fresh.join(names[0], "a").join(names[1], "b").select(F.col("a_in").alias("a"), F.col("b_in").alias("b"))
    moved = components(between.where("a != b").distinct()).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return keep(all_.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))


def _texts(docs: DataFrame, nodes: DataFrame, met: DataFrame) -> DataFrame:
    """(node, codes): the words' numbers of each node that shares a bucket, from the row that stands for it."""
    wanted = keep(met.select("node").distinct().join(nodes.select("node", "first.p1", "first.p2"), "node"))
    rows = docs.select(*_pointer(docs["doc_id"], docs["text"]), docs["text"].alias("text"))
    rows = rows.join(broadcast_if(wanted, 64 * wanted.count(), BROADCAST_BYTES), ["p1", "p2"]).select("node", "text")

    def work(batch: pa.RecordBatch) -> dict:
        return {"node": batch.column(0), "codes": [_codes(words(t)).tobytes() for t in batch.column(1).to_pylist()]}

    return keep(map_batches(rows, work, "node binary, codes binary").dropDuplicates(["node"]))


def _told(rows: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    component = F.coalesce("component", "node").alias("component")
    placed = keep(nodes.select("node", "first").join(found, "node", "left").select("node", "first", component))
    named = placed.groupBy("component").agg(F.min("first").alias("best"))
    by_node = keep(placed.join(named, "component").select("node", "best"))
    return rows.join(by_node, "node").select(
        "doc_id", "p1", "p2", "node", F.col("best.doc_id").alias("class_id"),
        ((F.col("p1") == F.col("best.p1")) & (F.col("p2") == F.col("best.p2"))).alias("first"))


def first_of_class(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """`docs`, all columns, one row of each class of near duplicates; also one of several equal rows."""
    told = keep(classes(docs, similar))
    gone = keep(told.where(~F.col("first")).select("p1", "p2").distinct())
    again = keep(told.where("first").groupBy("p1", "p2").count().where("count > 1").select("p1", "p2"))
    row = F.struct(F.lit(0).alias("_"), *[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), *_pointer(docs["doc_id"], docs["text"]))
    left = rows.join(broadcast_if(gone, 32 * gone.count(), BROADCAST_BYTES), ["p1", "p2"], "left_anti")
    repeated = broadcast_if(again, 32 * again.count(), BROADCAST_BYTES)
    once = left.join(repeated, ["p1", "p2"], "left_anti")
    several = left.join(repeated, ["p1", "p2"], "left_semi").groupBy("p1", "p2").agg(F.first("row").alias("row"))
    return once.select("row").unionByName(several.select("row")).select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])

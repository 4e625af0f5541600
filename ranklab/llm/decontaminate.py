"""Benchmark decontamination with suffix arrays of the training text.

Each task cuts its documents into shards of a bounded number of words and sorts
the shard's suffixes (prefix doubling). A suffix that starts with a word no
benchmark item has can match nothing, so only stretches of benchmark words are
indexed, which loses no match. Every suffix of every benchmark item is searched
by bisection; the range it finds holds all places of its first window, and the
neighbours give the longest match. Nothing is shuffled.

Equal benchmark texts are one text with several item ids. The benchmark travels to the
tasks in blocks cut by measured bytes; a larger benchmark makes more passes, each written
before the next one starts, so that the driver and a task hold one block at a time (a single
longer text, with its ids, is a block of its own).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, take, words
from ranklab.session import keep

WINDOW = 10
SHARD_WORDS = 1 << 20          # words of the documents that are indexed together (one longer document is a shard)
BLOCK_BYTES = 32 * 1024 * 1024   # benchmark text, with its ids, that goes to the tasks at once
ID_BYTES = 16                    # what an item id is counted as
SLICES = 16                      # a block is put together from about so many slices of measured size


@dataclass
class TestBlock:
    """The suffixes of a block of items, as numbers of words. text ends every item with a 0."""

    vocabulary: dict[bytes, int]
    text: np.ndarray            # words of all items
    items: list                 # of each text, its item ids, sorted
    start: np.ndarray           # of each searched suffix
    end: np.ndarray             # where its item ends
    item: np.ndarray            # which item
    need: np.ndarray            # words of its first window
    first: np.ndarray           # start of its item

    @classmethod
    def build(cls, rows: list[tuple], window: int) -> "TestBlock":
        """Of (text, its sorted item ids); texts go by their first id, so that a smaller number is a smaller id."""
        vocabulary: dict[bytes, int] = {}
        text, items, suffixes = [], [], []
        for body, ids in sorted(rows, key=lambda x: (_id_order(x[1][0]), x[0])):
            own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(body)]
            if not own:
                continue
            base, need = len(text), min(window, len(own))
            suffixes += [(base + j, base + len(own), len(items), need, base) for j in range(len(own) - need + 1)]
            items.append(ids)
            text += [*own, 0]
        columns = np.array(suffixes or np.zeros((0, 5)), np.int64).T
        return cls(vocabulary, np.array(text, np.int64), items, *columns)


def suffix_array(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """`starts` in the order of the suffixes there, compared over at least `depth` words."""
    rank, k = text, 1
    while k < depth:
        ahead = np.zeros_like(rank)
        ahead[:-k or None] = rank[k:]
        ahead[rank == 0] = 0                                # a 0 ends a suffix
        both = rank * (int(rank.max(initial=0)) + 1) + ahead
        both[rank == 0] = 0
        values, rank = np.unique(both, return_inverse=True)
        if values.size and values[0] != 0:
            rank = rank + 1
        k *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def _bisect(block: TestBlock, text: np.ndarray, order: np.ndarray, past: bool) -> np.ndarray:
    """For each test suffix the first place in `order` whose suffix is not below its first window (or, `past`, above it)."""
    low, high = np.zeros(len(block.start), np.int64), np.full(len(block.start), len(order), np.int64)
    while (going := np.flatnonzero(low < high)).size:
        middle = (low[going] + high[going]) // 2
        there, here, need = order[middle], block.start[going], block.need[going]
        sign, open_, depth = np.zeros(going.size, np.int64), np.arange(going.size), 0
        while open_.size:                                   # compare word by word while equal
            open_ = open_[need[open_] > depth]
            differ = text[there[open_] + depth] - block.text[here[open_] + depth]
            sign[open_] = np.sign(differ)
            open_, depth = open_[differ == 0], depth + 1
        right = sign <= 0 if past else sign < 0
        low[going[right]] = middle[right] + 1
        high[going[~right]] = middle[~right]
    return low


def search(block: TestBlock, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in it, test suffix, words of the longest match there) for all places of all test windows."""
    none = np.zeros(0, np.int64)
    if not len(block.start) or not docs:
        return none, none, none, none
    text = np.zeros(sum(map(len, docs)) + len(docs) + 1, np.int64)
    begin = np.cumsum([0, *(len(d) + 1 for d in docs[:-1])])
    for b, d in zip(begin, docs):
        text[b: b + len(d)] = d
    zeros = np.flatnonzero(text == 0)
    run = zeros[np.searchsorted(zeros, np.arange(len(text)))] - np.arange(len(text))
    indexed = np.flatnonzero(run >= block.need.min())
    if not indexed.size:
        return none, none, none, none
    inside = np.zeros(len(text) + 1, np.int64)              # stretches that are indexed, squeezed together with a 0 between
    np.add.at(inside, indexed, 1)
    np.add.at(inside, indexed + run[indexed], 0)
    stretch = run > 0
    firsts = np.flatnonzero(stretch & ~np.r_[False, stretch[:-1]])
    firsts = firsts[run[firsts] >= block.need.min()]
    lengths = run[firsts]
    places = np.repeat(firsts - np.r_[0, np.cumsum(lengths + 1)[:-1]], lengths + 1) + np.arange((lengths + 1).sum())
    small = np.append(text[places], 0)                      # every stretch ends with the 0 that ended it
    left = run[places]
    starts = np.flatnonzero(left >= block.need.min())
    order = suffix_array(small, starts, int((block.end - block.start).max()))
    padded = np.append(small, np.zeros(int(block.need.max()) + 1, np.int64))
    low, high = _bisect(block, padded, order, False), _bisect(block, padded, order, True)
    found = np.maximum(high - low, 0)
    suffix = np.repeat(np.arange(len(found)), found)
    at = order[np.repeat(low - np.r_[0, np.cumsum(found)[:-1]], found) + np.arange(found.sum())]
    longest = np.zeros(len(at), np.int64)
    going = np.arange(len(at))
    depth = 0
    limit = np.minimum(block.end[suffix] - block.start[suffix], left[at])
    while going.size:
        going = going[limit[going] > depth]
        going = going[small[at[going] + depth] == block.text[block.start[suffix[going]] + depth]]
        longest[going] += 1
        depth += 1
    place = places[at]
    doc = np.searchsorted(begin, place, "right") - 1
    return doc, place - begin[doc], suffix, longest


def _pass(block: TestBlock):
    """Adds what one block of items finds to the columns hits (merged word intervals), items and longest."""
    get = block.vocabulary.get

    def report(docs: list[np.ndarray]) -> list[tuple]:
        out: list[tuple] = [([], [], None)] * len(docs)
        doc, place, suffix, longest = search(block, docs)
        order = np.lexsort((place, doc))
        doc, place, suffix, longest = doc[order], place[order], suffix[order], longest[order]
        bounds = np.searchsorted(doc, np.arange(len(docs) + 1))
        for d in np.unique(doc):
            own = slice(bounds[d], bounds[d + 1])
            ends = place[own] + block.need[suffix[own]]
            items = [x for i in np.unique(block.item[suffix[own]]) for x in block.items[i]]
            first = np.lexsort((place[own], -longest[own]))[0]                # the longest, then the earliest
            best = suffix[own][(longest[own] == longest[own][first]) & (place[own] == place[own][first])]
            told = min(((_id_order(block.items[block.item[s]][0]), int(block.start[s] - block.first[s])) for s in best))
            out[d] = (_merge(zip(place[own].tolist(), ends.tolist())), items, {
                "item_id": told[0][1], "doc_word": int(place[own][first]), "item_word": told[1], "n_words": int(longest[own][first])})
        return out

    def work(batch: pa.RecordBatch) -> dict:
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        found, n_words, shard, size = [], [], [], 0
        for text in columns["text"].to_pylist():
            ids = np.array([get(w, 0) for w in words(text)], np.int64)
            n_words.append(len(ids))
            shard.append(ids)
            size += len(ids)
            if size >= SHARD_WORDS:
                found += report(shard)
                shard, size = [], 0
        found += report(shard)
        before = zip(columns["hits"].to_pylist(), columns["items"].to_pylist(), columns["longest"].to_pylist())
        merged = [(_merge([(x["begin"], x["end"]) for x in h] + new[0]), list(dict.fromkeys(i + new[1])), _longer(best, new[2]))
                  for (h, i, best), new in zip(before, found)]
        return columns | {"n_words": n_words, "hits": [[{"begin": b, "end": e} for b, e in h] for h, _, _ in merged],
                          "items": [i for _, i, _ in merged], "longest": [x for _, _, x in merged]}

    return work


def _merge(intervals) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(intervals):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(x) for x in out]


def _id_order(item_id) -> tuple:
    """Null ids first. Two ids of one table always compare."""
    return (item_id is not None, item_id)


def _longer(a: dict | None, b: dict | None) -> dict | None:
    """The longer match; of equal ones the earlier in the document, then the smaller id, then the earlier in the item."""
    def order(x: dict) -> tuple:
        return -x["n_words"], x["doc_word"], _id_order(x["item_id"]), x["item_word"]

    return min((x for x in (a, b) if x is not None), key=order, default=None)


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """(text, ids, slice): every text once, with its item ids; and ranges of slices of at most block_bytes each.

    The ids of equal texts meet in one row, as they do in a result row that reports them all.
    """
    tests = take(benchmark, item_id="item_id", text="text").where(F.octet_length("text") > 0)
    texts = keep(tests.groupBy("text").agg(F.collect_set(F.struct("item_id")).alias("ids")))
    size = F.octet_length("text") + F.lit(ID_BYTES) * F.size("ids")
    total = int(texts.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0)
    slices = 1 if total <= block_bytes else SLICES * -(-total // block_bytes)
    cut = texts.withColumn("slice", F.pmod(F.xxhash64("text"), F.lit(slices)).cast("int"))
    if slices == 1:
        return cut, [(0, 0)] if total else []
    ranges: list[list[int]] = []
    held = 0
    for at, n in sorted(map(tuple, cut.groupBy("slice").agg(F.sum(size.cast("long"))).collect())):
        if ranges and held + n <= block_bytes:
            ranges[-1][1], held = at, held + n
        else:
            ranges.append([at, at])
            held = n
    return cut, [tuple(x) for x in ranges]


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of `docs`' own doc_id, text, and: n_words, hits (intervals of hit words), items, longest.

    A window is `window` consecutive words of an item, or a whole shorter item. items holds
    each item id with a window in the document once. longest is the longest verbatim match that
    begins with a window (item_id, doc_word, item_word, n_words) or null; of equally long ones the earliest
    in the document, then that of the smallest item id, then the earliest in the item. Null and empty texts
    have no words; very long ones are a shard of their own, whole; repeated rows are reported each; repeated
    items count once; an item with a null id counts as an item of that id. Without items, or with items
    without words, nothing is hit; an empty table of documents gives no rows.
    """
    item_type = benchmark.schema["item_id"].dataType
    rows = take(docs, doc_id="doc_id", text="text")
    match = T.StructType().add("item_id", item_type).add("doc_word", "long").add("item_word", "long").add("n_words", "long")
    schema = T.StructType(list(rows.schema.fields)).add("n_words", "long").add(
        "hits", T.ArrayType(T.StructType().add("begin", "long").add("end", "long"))).add(
        "items", T.ArrayType(item_type)).add("longest", match)
    found = rows.select("*", F.lit(0).cast("long").alias("n_words"),
                        *[F.lit(v).cast(schema[n].dataType).alias(n) if v is None else F.array().cast(schema[n].dataType).alias(n)
                          for n, v in (("hits", ()), ("items", ()), ("longest", None))])
    texts, ranges = _blocks(benchmark, block_bytes)
    for nth, (low, high) in enumerate(ranges or [(0, -1)]):
        own = [(r["text"], sorted((x["item_id"] for x in r["ids"]), key=_id_order))
               for r in texts.where(F.col("slice").between(low, high)).toLocalIterator()]
        found = map_batches(keep(found) if nth else found, _pass(TestBlock.build(own, window)), schema)
        del own
    return found


def digest(found: DataFrame) -> DataFrame:
    """One row per document with counts and a checksum of the matching items."""
    ids = F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string"))))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                        F.col("longest.item_id").alias("longest_item"), F.col("longest.doc_word").alias("longest_doc_word"),
                        F.col("longest.item_word").alias("longest_item_word"), F.col("longest.n_words").alias("longest_words"))


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs`, all columns, without the rows in which a benchmark window occurs."""
    rest = F.struct(F.lit(0).alias("_"), *[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
    found = matches(docs.select(rest.alias("doc_id"), docs["text"].alias("text")), benchmark, window, block_bytes)
    return found.where(F.size("hits") == 0).select(*[
        F.col("text") if c == "text" else F.col(f"doc_id.c{i}").alias(c) for i, c in enumerate(docs.columns)])

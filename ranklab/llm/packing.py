"""Best-fit packing of documents into sequences of a fixed number of tokens.

Tokenising is a narrow pass that also numbers the pieces of each length within
a task. All that the packing itself needs is how many pieces there are of each
length: at most `size` numbers, whatever the input. The plan made of them is a
list of patterns (which lengths lie together, how many times); a piece finds
its place from its length and its rank among the pieces of that length, and the
rank is the task's offset (a running sum over tasks) plus the number in the task.
No length, however common, meets in one task.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ranklab.llm.common import map_batches, take
from ranklab.session import keep

SIZE = 1024
END_ID = 2
CACHED_WORDS = 500_000   # split words whose ids a worker remembers, at most

# The split of byte-level BPE, for texts of ASCII and Latin letters only. Other texts go to the tokenizer whole.
_LETTERS, _SPACES = "A-Za-zÀ-ÖØ-öø-ɏ", "\\t-\\r "
_PLAIN = re.compile(f"[\\x00-\\x7f{_LETTERS}]*")
_SPLIT = re.compile(f"'(?:[sdmt]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_SPACES}{_LETTERS}0-9]+"
                    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


class Ids:
    """Token ids of texts as little-endian 32-bit numbers; the ids of a split word are looked up once."""

    _open: dict[str, "Ids"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")      # texts with one go to the tokenizer whole
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "Ids":
        """The one of this worker."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or self.added.search(text):
            return self._encode([text])[0]
        split, known = _SPLIT.findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, split))
        except KeyError:
            pass
        if len(known) > CACHED_WORDS:
            known.clear()
        new = list({w for w in split if w not in known})
        known.update(zip(new, self._encode(new)))
        return b"".join(map(known.__getitem__, split))


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, ordinal[, ids]): each document's ids, cut only where longer than `size`.

    Of a longer document the first piece takes what is over, so that all others are full.
    ordinal numbers the pieces of one length within a task.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("piece", "integer").add(
        "start", "long").add("length", "integer").add("ids_crc32", "long").add("task", "integer").add("ordinal", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    end, seen = np.array([end_id], "<u4").tobytes(), {}

    def work(batch: pa.RecordBatch) -> dict:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, task = Ids.of(tokenizer), TaskContext.get().partitionId()
        counts = seen.setdefault((task, TaskContext.get().taskAttemptId()), np.zeros(size + 1, np.int64))
        rows: list[tuple] = []
        for at, text in enumerate(batch.column(1).to_pylist()):
            ids = encode(text or "") + end
            n, start, piece = len(ids) // 4, 0, 0
            while start < n:
                length = size if start else (n - 1) % size + 1
                own = ids[4 * start: 4 * (start + length)]
                rows.append((at, piece, start, length, zlib.crc32(own), counts[length], own if with_ids else None))
                counts[length] += 1
                start, piece = start + length, piece + 1
        at, piece, start, length, crc, ordinal, own = zip(*rows) if rows else [()] * 7
        out = {"doc_id": batch.column(0).take(pa.array(at, pa.int64())), "piece": piece, "start": start, "length": length,
               "ids_crc32": crc, "task": [task] * len(at), "ordinal": ordinal}
        return out | ({"ids": [np.frombuffer(x, "<u4").tolist() for x in own]} if with_ids else {})

    return map_batches(take(docs, doc_id="doc_id", text="text"), work, schema)


@dataclass(frozen=True)
class Pattern:
    lengths: tuple[int, ...]   # descending
    copies: int


def _fitting(gap: int, have: np.ndarray, own: int, most: int) -> tuple[int, ...] | None:
    """One, two or three (`most` at most) available lengths that sum to `gap`; `own` is already used once.

    Even sums come first: short lengths, which fit anywhere, are left for the end.
    """
    left = have.copy()
    left[own] -= 1
    there = np.flatnonzero(left[: gap + 1])
    there = there[there > 0]
    if len(there) and there[-1] == gap:
        return (gap,)
    if not len(there) or most < 2:
        return None
    marked = np.zeros(gap + 1, bool)                       # singles by their length
    marked[there] = True
    pairs = there[marked[gap - there] & (2 * there >= gap)]   # a with gap - a there too, the most even first
    for a in pairs:
        if 2 * a != gap or left[a] > 1:
            return (int(a), int(gap - a))
    if most < 3:
        return None
    sums = np.full(gap + 1, -1, np.int64)                  # pairs by their sum
    for b in there:
        own_sums = there[there <= min(b, gap - b)]
        if left[b] < 2:
            own_sums = own_sums[own_sums != b]
        sums[own_sums + b] = b
    for a in there[(sums[gap - there] > 0) & (3 * there >= gap)]:
        b = int(sums[gap - a])
        three = (int(a), b, int(gap - a - b))
        if all(left[x] >= three.count(x) for x in three):
            return tuple(sorted(three, reverse=True))
    return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Which lengths lie together: of some orders of taking exact complements, the one that needs the fewest sequences."""
    orders = [(1, 2, 3), (1, 2), (3,), (2, 3), (1,), (2,)]
    return min((_plan(counts, size, order) for order in orders), key=lambda p: sum(x.copies for x in p))


def _plan(counts: dict[int, int], size: int, order: tuple[int, ...]) -> list[Pattern]:
    """Every step uses up one length or a combination, so the plan's size is bounded by `size`.

    In each round of `order`, longest first: as many lengths as the round says that
    fill the gap exactly are taken as often as they are there; lengths without such
    a complement are placed best-fit in the end, the longest first, each into the
    open sequences with the smallest gap that takes it.
    """
    have = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    done = [Pattern((size,), int(have[size]))] if have[size] else []
    have[size] = 0
    for most in order:
        for length in range(size - 1, 0, -1):
            while have[length] and (rest := _fitting(size - length, have, length, most)):
                lengths = (length, *rest)
                copies = min(int(have[x]) // lengths.count(x) for x in set(lengths))
                done.append(Pattern(tuple(sorted(lengths, reverse=True)), copies))
                for x in lengths:
                    have[x] -= copies
    open_: dict[int, dict[tuple[int, ...], int]] = {}      # gap -> lengths so far -> sequences
    for length in range(size - 1, 0, -1):
        left = int(have[length])
        while left:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                each = size // length
                full, over = divmod(left, each)
                for n, copies in ((each, full), (over, 1)):
                    if n and copies:
                        group = open_.setdefault(size - n * length, {})
                        group[(length,) * n] = group.get((length,) * n, 0) + copies
                break
            lengths, copies = next(iter(open_[gap].items()))
            each = min(gap // length, left)
            used = min(copies, left // each)
            for key, by in ((gap, -used), (gap - each * length, used)):
                at = lengths if by < 0 else lengths + (length,) * each
                group = open_.setdefault(key, {})
                group[at] = group.get(at, 0) + by
                if not group[at]:
                    del group[at]
                if not group:
                    del open_[key]
            left -= each * used
    done += [Pattern(lengths, copies) for group in open_.values() for lengths, copies in group.items()]
    return done


def _runs(patterns: list[Pattern], size: int) -> dict[str, np.ndarray]:
    """For the ranks of each length, in order: from which rank on, which sequence, how many in a sequence, at what offset."""
    rows, taken, sequence = [], np.zeros(size + 1, np.int64), 0
    for p in patterns:
        offset = 0
        for length in dict.fromkeys(p.lengths):
            each = p.lengths.count(length)
            rows.append((length << 44 | int(taken[length]), int(taken[length]), sequence, each, offset))
            taken[length] += each * p.copies
            offset += each * length
        sequence += p.copies
    rows.sort()
    return dict(zip(("key", "first", "sequence", "each", "offset"), np.array(rows or np.zeros((0, 5)), np.int64).T))


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: sequence_id, and offset there, gapless from 0.

    Null and empty texts are one piece that holds the end id. Repeated rows and rows with a
    null id are packed as rows of their own; an empty table gives no rows. Texts of any length
    are cut, never shortened. Other columns of `docs` are not read.
    """
    cut = keep(pieces(docs, tokenizer, size, end_id, with_ids))
    per_task = keep(cut.groupBy("task", "length").agg(F.count("*").alias("n")))
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    runs = _runs(plan(counts, size), size)

    def place(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        length = out["length"].to_numpy(zero_copy_only=False).astype(np.int64)
        rank = out["before"].to_numpy(zero_copy_only=False) + out["ordinal"].to_numpy(zero_copy_only=False)
        at = np.searchsorted(runs["key"], length << 44 | rank, "right") - 1
        copy, slot = np.divmod(rank - runs["first"][at], runs["each"][at])
        return out | {"sequence_id": runs["sequence"][at] + copy, "offset": runs["offset"][at] + slot * length}

    schema = T.StructType([f for f in cut.schema if f.name not in ("task", "ordinal", "length")]).add(
        "length", "long").add("sequence_id", "long").add("offset", "long")
    ranked = cut.join(keep(before), ["task", "length"])
    return map_batches(ranked.withColumn("length", F.col("length").cast("long")), place, schema)

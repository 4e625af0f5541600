"""Conversations brought into the order (system) (user assistant)+ by the cheapest edits.

The turns of a conversation are aligned (Wagner and Fischer) to the strings of the grammar
`(s?(ua)+)?`. All strings of even length are beginnings of "uaua...", all of odd length of
"suaua...", so two tables hold the costs of every feasible length: the cost of a length is
the last row's entry in its column. Only columns inside Ukkonen's band are filled: an entry
that cannot lead to the incumbent cost (that of a greedy repair) is left out, and the band
follows the entries that can. For the lengths that share the least cost, all tight edges are
traced back, and the smallest audit is read off forwards; of the two tables' audits the
smaller one is the answer. Of a table only every so many rows are kept; the rows between are
filled again when the trace comes by, so that memory grows with the band, not with the table.

Equal patterns of roles and faults have equal answers, so a task solves each pattern once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ranklab.llm.common import take

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANK = r"\A[\x20\x09-\x0D]*\z"
UNENDED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"
HELD_PATTERNS = 200_000     # solved patterns that a task remembers
_FAR = np.int64(1) << 60


class _Table:
    """Costs of aligning the first p turns with the first j symbols of one string, for all p and the j in the band."""

    def __init__(self, turns: str, leading: str, limit: int):
        self.turns, self.leading, self.limit = turns, leading, limit
        self.m = len(turns)
        # turns are s, u, a or another letter; upper case: truncated
        cut = np.fromiter((c.isupper() for c in turns), np.int64, self.m) * TRUNCATED
        self.cut = cut
        self.rest = np.concatenate((np.cumsum(cut[::-1])[::-1], [0])) if self.m else np.zeros(1, np.int64)   # truncated turns still to come
        self.width = self.m + limit // INSERT + 2
        self.step = max(1, math.isqrt(self.m + 1))
        self.kept: dict[int, tuple[int, np.ndarray]] = {}
        row = self._row(0, None)
        for p in range(self.m + 1):
            if p:
                row = self._row(p, row)
            if p % self.step == 0:
                self.kept[p] = row
        self.last = row

    def symbol_costs(self, p: int, start: int, stop: int) -> np.ndarray:
        """Cost of turning turn p into the symbols `start` to `stop` (keep or rerole), without the fault's cost."""
        own = self.turns[p].lower()
        j = np.arange(start, stop)
        head = len(self.leading)
        cost = np.full(stop - start, REROLE, np.int64)
        if own in "ua":
            cost[(j - head) % 2 == "ua".index(own)] = KEEP
        if head and start == 0 and stop > 0:
            cost[0] = KEEP if own == "s" else _FAR
        return cost

    def _row(self, p: int, before: tuple[int, np.ndarray] | None) -> tuple[int, np.ndarray]:
        if before is None:
            start, stop = 0, min(self.width, self.limit // INSERT + 1)
            best = np.full(stop, _FAR)
            best[0] = 0
        else:
            start, old = before
            # cheap bounds of the band: one symbol farther than the row before, then by inserts
            slack = max(0, self.limit - int(old.min())) // INSERT
            stop = min(self.width, start + len(old) + 1 + slack)
            best = np.full(stop - start, _FAR)
            best[:len(old)] = old + DELETE
            reach = min(len(old), stop - start - 1)
            taken = old[:reach] + self.symbol_costs(p - 1, start, start + reach) + self.cut[p - 1]
            best[1:reach + 1] = np.minimum(best[1:reach + 1], taken)
        # inserts run to the right; the leading s cannot be inserted
        at = np.arange(start, start + len(best), dtype=np.int64) * INSERT
        first = 1 if self.leading and start == 0 else 0
        tail = best[first:]
        if len(tail):
            np.minimum(tail, np.minimum.accumulate(tail - at[first:]) + at[first:], out=tail)
        # the band: what can still end within the limit; a later cut turn costs at least 3 whatever becomes of it
        alive = np.flatnonzero(best + self.rest[p] <= self.limit)
        if not len(alive):
            return start, best[:0] if len(best) == 0 else np.full(1, _FAR)
        return start + int(alive[0]), best[alive[0]:alive[-1] + 1].copy()

    def rows(self, low: int, high: int) -> list[tuple[int, np.ndarray]]:
        """Rows `low` to `high`, filled again from the kept one before."""
        p = low - low % self.step
        row, out = self.kept[p], []
        while True:
            if p >= low:
                out.append(row)
            if p == high:
                return out
            p += 1
            row = self._row(p, row)

    def ends(self) -> dict[int, int]:
        """Cost of every feasible length in the band."""
        start, row = self.last
        return {start + i: int(c) for i, c in enumerate(row.tolist()) if c < _FAR and self.feasible(start + i)}

    def feasible(self, length: int) -> bool:
        return length % 2 == len(self.leading) and length != 1

    def audit(self, ends: list[int]) -> str:
        """Smallest string of edits on a cheapest path to one of the lengths `ends`, which cost the same."""
        if not self.m:
            return ""                                       # nothing to align: only the empty string is cheapest
        # back: which entries lie on a path to an end
        marks: list[tuple[int, np.ndarray] | None] = [None] * (self.m + 1)      # first column, one bit an entry
        goal = np.zeros(len(self.last[1]), bool)
        goal[[e - self.last[0] for e in ends]] = True
        high = self.m
        while high >= 0:
            low = max(0, high - high % self.step)
            block = self.rows(low, high)
            for p in range(high, low - 1, -1):
                start, row = block[p - low]
                on = goal if p == self.m else np.zeros(len(row), bool)
                if p < self.m:
                    after_start, after, after_on = below
                    j = np.arange(start, start + len(row))
                    for shift, cost in ((0, DELETE), (1, None)):
                        k = j + shift - after_start
                        inside = (k >= 0) & (k < len(after))
                        kk = np.where(inside, k, 0)
                        price = cost if cost is not None else self.symbol_costs(p, start, start + len(row)) + self.cut[p]
                        on |= inside & after_on[kk] & (row + price == after[kk])
                # inserts within the row, from the right; an entry that an insert reaches costs 3 more than its left one
                tight = np.zeros(len(row), bool)
                if len(row) > 1:
                    tight[:-1] = row[1:] == row[:-1] + INSERT
                    if self.leading and start == 0:
                        tight[0] = False
                    on = _spread(on, tight)
                marks[p] = start, np.packbits(on)
                below = start, row, on
            high = low - 1
        # forth: the smallest letter that stays on such a path; D < I < K < R
        out, p, j = [], 0, 0
        block_low, block = -1, []

        def entry(p: int, j: int) -> int | None:
            nonlocal block_low, block
            low = p - p % self.step
            if low != block_low:
                block_low, block = low, self.rows(low, min(self.m, low + self.step - 1))
            start, row = block[p - low]
            k = j - start
            return int(row[k]) if 0 <= k < len(row) and marks[p][1][k >> 3] >> (7 - (k & 7)) & 1 else None

        goals = set(ends)
        here = entry(0, 0)
        while not (p == self.m and j in goals):
            down = entry(p + 1, j) if p < self.m else None
            if down is not None and down == here + DELETE:
                out.append("D")
                p, here = p + 1, down
                continue
            right = entry(p, j + 1) if not (self.leading and j == 0) else None
            if right is not None and right == here + INSERT:
                out.append("I")
                j, here = j + 1, right
                continue
            change = int(self.symbol_costs(p, j, j + 1)[0])
            here = entry(p + 1, j + 1)
            out.append("K" if change == KEEP else "R")
            p, j = p + 1, j + 1
        return "".join(out)


def _spread(on: np.ndarray, tight: np.ndarray) -> np.ndarray:
    """Marks move left over runs of tight places."""
    n = len(on)
    at = np.arange(n)
    stop = np.where(~tight, at, n)                          # the first place from here that is not tight
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    marked = np.where(on, at, n)
    marked = np.minimum.accumulate(marked[::-1])[::-1]      # the next mark from here
    return marked <= stop


def greedy(turns: str, leading: str) -> int:
    """Cost of a repair that never deletes: the incumbent."""
    cost, head = 0, len(leading)
    if head and turns[:1].lower() != "s":
        return 1 << 40
    expected = "s" if head else "u"
    n = 0
    for c in turns:
        own = c.lower()
        cost += TRUNCATED * c.isupper()
        if own != expected:
            if own in "ua" and expected != "s":
                cost += INSERT
                n += 1
            else:
                cost += REROLE
                own = expected
        n += 1
        expected = "a" if own == "u" else "u"
    if (n - head) % 2:
        cost += INSERT
        n += 1
    return cost if n != 1 else cost + 2 * INSERT


def align(turns: str) -> tuple[int, str]:
    """Least cost, and the smallest of the audits that have it, for turns that need not go.

    A turn is a letter: s, u, a or another (x) for its role, upper case if it is truncated.
    """
    limit = min(DELETE * len(turns), greedy(turns, ""), greedy(turns, "s"))
    tables = [_Table(turns, leading, limit) for leading in ("", "s")]
    costs = [t.ends() for t in tables]
    least = min(c for ends in costs for c in ends.values())
    audits = [t.audit([n for n, c in ends.items() if c == least]) for t, ends in zip(tables, costs) if least in ends.values()]
    return least, min(audits)


def with_faults(pattern: str) -> tuple[int, str]:
    """`align` for turns among which a `-` is one that has to go: its D comes as early as it can."""
    cost, audit = align(pattern.replace("-", ""))
    out, edits = [], iter(audit)
    gone = 0
    waiting = next(edits, None)
    for c in pattern:
        if c == "-":
            out.append("D")
            gone += 1
            continue
        while waiting == "I":
            out.append("I")
            waiting = next(edits, None)
        out.append(waiting)
        waiting = next(edits, None)
    while waiting:
        out.append(waiting)
        waiting = next(edits, None)
    return cost + DELETE * gone, "".join(out)


def repaired(audit: str, roles: list[str], texts: list[str]) -> list[tuple[str, str]]:
    """(role, text) of the turns that the edits give."""
    out: list[tuple[str, str]] = []
    turns = iter(zip(roles, texts))
    final = sum(e != "D" for e in audit)
    for e in audit:
        if e == "D":
            next(turns)
            continue
        expected = "user" if (len(out) - final % 2) % 2 == 0 else "assistant"
        if e == "I":
            out.append((expected, ""))
        else:
            role, text = next(turns)
            out.append((role if e == "K" else expected, text))
    return out


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after damage, in conversations' own columns' names, with `dropped` and `copy`.

    Null roles and texts become one space. crc32("conv_id:turn") % 20, a null there also being a
    space, says what happens: 0 drops the row (it stays, marked, so that its conversation is
    known), 1 empties its text, 2 removes `[.!?]` from it, 3 adds the row once more, 4 sets the role user.
    """
    rows = take(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("kind")
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.crc32(name) % 20).alias("kind"))
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("dropped"), F.explode(copies).alias("copy"))


_REPAIR = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired array<struct<role string, text string>>")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conv_id in `turns` (conv_id, turn, role, text, dropped): its faults, cheapest edits and repaired turns.

    Turns are in the order of turn (null first), those of one turn by role and text; a row's
    first fault counts: blank, duplicate (role and text seen earlier), truncated (no end mark).
    Null roles and texts are one space, a role's initial is its first character (none if
    empty). Null is a conv_id like others. Rows marked `dropped` only name their conversation;
    without other rows it has zeros and empty results. No rows: none. Texts of any length are read whole.

    A task reads its conversations one after the other, sorted by Spark, and holds one at a
    time: a conversation has to fit into a task's memory, like any row; the table itself is
    bounded by its band (see above).
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = take(turns, conv_id="conv_id", turn="turn", role="role", text="text", dropped="dropped").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    rows = rows.withColumn("fault", F.when(F.col("text").rlike(BLANK), 1).when(F.col("text").rlike(UNENDED), 2).otherwise(0))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(_REPAIR).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, solved = to_arrow_schema(kind), {}
        made: list[dict] = []
        held = 0
        for conv_id, own in _conversations(batches):
            row = _mended(own, solved)
            made.append({"conv_id": conv_id, **row})
            held += 1 + sum(len(t["text"]) for t in row["repaired"])
            if held > 4_000_000 or len(made) == 10_000:
                yield pa.RecordBatch.from_pylist(made, arrow)
                made, held = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, arrow)

    return ordered.mapInArrow(run, kind)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    none = object()
    last, own = none, []
    for batch in batches:
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_id != last and last is not none:
                yield last, own
                own = []
            last = conv_id
            own.append(row)
    if last is not none:
        yield last, own


def _mended(rows: list[list], solved: dict[str, tuple[int, str]]) -> dict:
    seen: set[tuple[str, str]] = set()
    roles, texts, numbers, pattern = [], [], set(), []
    counts = [0, 0, 0]                                       # blank, truncated, duplicate
    illegal, before = 0, None
    for turn, role, text, dropped, fault in rows:
        if dropped:
            continue
        if fault != 1 and (role, text) in seen:
            fault = 3
        seen.add((role, text))
        if fault:
            counts[fault - 1] += 1
        initial = role[:1]
        illegal += before is not None and before + initial not in ("su", "ua", "au")
        before = initial
        letter = initial if initial in ("s", "u", "a") else "x"
        pattern.append("-" if fault in (1, 3) else letter.upper() if fault == 2 else letter)
        roles.append(role)
        texts.append(text)
        if turn is not None:
            numbers.add(turn)
    key = "".join(pattern)
    if key not in solved:
        if len(solved) >= HELD_PATTERNS:
            solved.clear()
        solved[key] = with_faults(key)
    cost, audit = solved[key]
    return {"gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            "blank": counts[0], "truncated": counts[1], "duplicate": counts[2], "illegal": illegal, "cost": cost, "audit": audit,
            "repaired": [{"role": r, "text": t} for r, t in repaired(audit, roles, texts)]}


def digest(mended: DataFrame) -> DataFrame:
    """The repaired turns as the SHA-256 of their `role:text` lines."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return mended.select(*[c for c in mended.columns if c != "repaired"], F.sha2(F.encode(F.array_join(lines, "\n"), "UTF-8"), 256).alias("repaired_sha256"))

"""License scans: ordered signature rules over a document's words.

A rule is a regex over the words joined by single blanks, with a label, a priority
and keywords. The keywords gate it: a document without any of a rule's keywords
never meets its regex, and most documents meet none. Of overlapping detections
a detection is suppressed that lies within a kept one of at least its priority;
what is left gives the labels. The base phrases are rules like the others, but
what they find is never suppressed.

The rules (`license_rules`) are written by hand, several hundred of them: tags, names with and
without versions, short forms, granting sentences, sentences of the license texts, exceptions
and statements about rights.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, take, words
from ranklab.llm.license_rules import RULES

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]
    base: bool = False


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, the highest priority first."""
    made = [Rule(label, 100, (min(phrase.split(), key=lambda w: (w in ("all", "by"), -len(w))),),
                 re.compile(f"(?<= ){phrase}(?= )".encode()), True) for phrase, label in BASE.items()]
    made += [Rule(label, priority, tuple(keywords.split()), re.compile(f"(?<= )(?:{pattern})(?= )".encode()))
             for label, priority, keywords, pattern in RULES]
    return tuple(sorted(made, key=lambda r: (-r.base, -r.priority)))


@dataclass(frozen=True)
class Detection:
    start: int      # words, end exclusive
    end: int
    rule: Rule


def detect(own: list[bytes], gate: dict[bytes, list[int]], ordered: tuple[Rule, ...]) -> list[Detection]:
    """All detections in a document's words, before suppression."""
    if gate.keys().isdisjoint(own):
        return []
    asked = sorted({i for w in gate.keys() & set(own) for i in gate[w]})
    joined = b" " + b" ".join(own) + b" "
    begins = list(accumulate((len(w) + 1 for w in own), initial=1))
    found = []
    for i in asked:
        # base places may overlap; a search from the next word finds them all
        at, pattern = 0, ordered[i].pattern
        while hit := pattern.search(joined, at):
            start, end = bisect_right(begins, hit.start()) - 1, bisect_right(begins, hit.end())
            found.append(Detection(start, end, ordered[i]))
            at = begins[start] + len(own[start]) if ordered[i].base else hit.end()
    return found


def suppress(found: list[Detection]) -> list[Detection]:
    """Without detections that lie within a kept one of at least their priority; base detections stay and suppress nothing."""
    kept: list[Detection] = []
    starts: list[int] = []     # the widest kept intervals: none holds another, so starts and ends both rise
    ends: list[int] = []
    for d in sorted((d for d in found if not d.rule.base), key=lambda d: (-d.rule.priority, d.start - d.end, d.start, d.rule.label)):
        at = bisect_right(starts, d.start)
        if at and ends[at - 1] >= d.end:
            continue
        kept.append(d)
        at -= bool(at and starts[at - 1] == d.start)
        upto = bisect_right(ends, d.end, at)
        starts[at:upto], ends[at:upto] = [d.start], [d.end]
    return sorted(kept, key=lambda d: (d.start, d.end, d.rule.label))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row of `docs`.

    spans: the kept detections (label, start, end, priority) in words. score: the priority of
    the strongest detection over 100, base phrases included (their own priority is 50 there);
    0 without any. Of rules that tie on an interval the first label in the alphabet stays. Null and
    empty texts have no words and no labels; very long ones are scanned whole, in one task each;
    repeated rows and null ids are judged each; an empty table gives no rows; other columns are not read.
    """
    span = T.ArrayType(T.StructType().add("label", "string").add("start", "long").add("end", "long").add("priority", "integer"))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("n_words", "long").add("n_base", "long").add(
        "first_word", "long").add("last_word", "long").add("base_labels", "string").add("labels", "string").add("score", "double").add("spans", span)

    def work(batch: pa.RecordBatch) -> dict:
        ordered = rules()
        gate: dict[bytes, list[int]] = {}
        for i, r in enumerate(ordered):
            for k in r.keywords:
                gate.setdefault(k.encode(), []).append(i)
        rows = []
        for text in batch.column(1).to_pylist():
            own = words(text)
            found = detect(own, gate, ordered)
            base = [d for d in found if d.rule.base]
            kept = suppress(found)
            labels = {d.rule.label for d in base}
            strength = [50] * bool(base) + [d.rule.priority for d in kept]
            rows.append((len(own), len(base), min((d.start for d in base), default=None), max((d.start for d in base), default=None),
                         ",".join(sorted(labels)), ",".join(sorted(labels | {d.rule.label for d in kept})), max(strength, default=0) / 100,
                         [{"label": d.rule.label, "start": d.start, "end": d.end, "priority": d.rule.priority} for d in kept]))
        return {"doc_id": batch.column(0)} | dict(zip(schema.names[1:], map(list, zip(*rows)) if rows else [[]] * 8))

    return map_batches(take(docs, doc_id="doc_id", text="text"), work, schema)


def digest(found: DataFrame) -> DataFrame:
    return found.drop("spans")

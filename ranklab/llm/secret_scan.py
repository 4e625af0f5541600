"""Secret scans through a trigram inverted index, in built-in functions only.

From each rule's regex follows which trigrams a text must hold: a list of
alternatives, each a set of trigrams (lower case, so one index serves rules of
either case). The index has a posting (trigram, document key) for every trigram
of these sets in every text. Postings are intersected by key: the bits of a
document's trigrams are combined before and after the shuffle, so a frequent
trigram is no hot group, and a rule's documents are those with all bits of one of
its alternatives. Only they are verified with the regex. A rule without mandatory
trigrams scans all texts.

A document key is a hash of id and text; should two documents share one, both are
verified, so the result does not depend on it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ranklab.llm.common import take
from ranklab.session import keep

WORD_BITS = 62
BROADCAST_CANDIDATES = 500_000    # 24 bytes each; more are joined by a shuffle


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str                       # Java and Python read it alike
    value_group: int | None = None     # a match counts only if this group ...
    value_length: int = 0              # ... has so many characters


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY"),
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
)
RULES = BASE + MORE


def trigram_query(pattern: str, most: int = 32) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, one of which any match holds in full (lower case); None if some match need hold none.

    Neighbouring literals are joined; whatever may vary ends the run of literals,
    which only makes the query weaker, never wrong.
    """
    from re import _constants as k, _parser

    def closed(state: tuple[str, frozenset[str]]) -> tuple[str, frozenset[str]]:
        run, known = state
        return "", known | {run[i:i + 3] for i in range(len(run) - 2)}

    def walk(nodes, states: list[tuple[str, frozenset[str]]]) -> list[tuple[str, frozenset[str]]]:
        for op, arg in nodes:
            if op is k.LITERAL:
                states = [(run + chr(arg).lower(), known) for run, known in states]
            elif op is k.IN and len(states) * len(arg) <= most and all(kind is k.LITERAL for kind, _ in arg):
                states = [(run + chr(c).lower(), known) for run, known in states for _, c in arg]
            elif op is k.SUBPATTERN:
                states = walk(arg[3], states)
            elif op is k.BRANCH and len(states) * len(arg[1]) <= most:
                states = [s for branch in arg[1] for s in walk(branch, states)]
            elif op is k.MAX_REPEAT and arg[0] == arg[1] == 1:
                states = walk(arg[2], states)
            elif op is k.MAX_REPEAT and arg[0] >= 1:
                states = [closed(s) for s in walk(arg[2], [closed(s) for s in states])]
            else:
                states = [closed(s) for s in states]
        return states

    found = [closed(s)[1] for s in walk(_parser.parse(pattern), [("", frozenset())])]
    return None if not all(found) else list(dict.fromkeys(found))


@dataclass(frozen=True)
class Queries:
    """The trigrams of a set of rules, numbered, and each rule's alternatives as bit masks."""

    trigrams: list[str]
    masks: dict[int, list[list[int]]]   # rule -> alternatives -> words of bits

    @classmethod
    def of(cls, rules: tuple[Rule, ...]) -> "Queries":
        asked = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern))}
        trigrams = sorted({t for q in asked.values() for alternative in q for t in alternative})
        words = -(-len(trigrams) // WORD_BITS)
        bits = lambda alternative: [sum(1 << n % WORD_BITS for n, t in enumerate(trigrams)
                                        if t in alternative and n // WORD_BITS == w) for w in range(words)]
        return cls(trigrams, {i: [bits(a) for a in q] for i, q in asked.items()})


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(doc_id, text)


def postings(docs: DataFrame, queries: Queries) -> DataFrame:
    """(trigram, key): the inverted index over the trigrams that rules ask for."""
    listed = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(t).alias("t")) for i, t in enumerate(queries.trigrams)])
    held = F.transform(F.array(F.lower("text")), lambda low: F.transform(
        F.filter(listed, lambda x: F.contains(low, x["t"])), lambda x: x["n"]))
    return docs.select(F.explode(held[0]).alias("trigram"), document_key().alias("key"))


def candidates(index: DataFrame, queries: Queries) -> DataFrame:
    """(key, rules): documents in the intersection of a rule's postings; rules has a bit for each such rule."""
    words = -(-len(queries.trigrams) // WORD_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("trigram") % WORD_BITS)
    held = index.groupBy("key").agg(*[F.bit_or(F.when(F.floor(F.col("trigram") / WORD_BITS) == w, bit).otherwise(
        F.lit(0).cast("long"))).alias(f"w{w}") for w in range(words)])
    rules = F.lit(0).cast("long")
    for rule, alternatives in queries.masks.items():
        hit = F.lit(False)
        for masks in alternatives:
            all_ = F.lit(True)
            for w, mask in enumerate(masks):
                if mask:
                    all_ = all_ & (F.col(f"w{w}").bitwiseAND(F.lit(mask)) == F.lit(mask))
            hit = hit | all_
        rules = rules.bitwiseOR(F.when(hit, F.lit(1 << rule).cast("long")).otherwise(F.lit(0).cast("long")))
    return held.select("key", rules.alias("rules")).where(F.col("rules") != 0)


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(rule: Rule, kind: int) -> Column:
    """Places of the leftmost non-overlapping matches, in code points.

    The text is read as (what lies before a match, the match) again and again; \\G keeps
    a failed search from starting anew behind every character.
    """
    # regexp_extract_all gives one group at a time: 1 is what lies before, 2 the match.
    step = F.lit(rf"\G(?s:(.*?))({rule.pattern})")
    pairs = F.arrays_zip(F.regexp_extract_all("text", step, F.lit(1)).alias("gap"),
                         F.regexp_extract_all("text", step, F.lit(2)).alias("hit"))

    def add(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        counts = F.lit(True) if rule.value_group is None else \
            F.length(F.regexp_extract(pair["hit"], rule.pattern, rule.value_group)) >= rule.value_length
        own = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))).cast(_SPAN)
        return F.struct(end.alias("at"), F.when(counts, F.concat(so_far["found"], own)).otherwise(so_far["found"]).alias("found"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))
    return F.aggregate(pairs, first.cast(f"struct<at:int,found:{_SPAN}>"), add, lambda x: x["found"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, into: str = "spans") -> DataFrame:
    """`docs`, all columns, and `into`: array of (start, kind, end) by start, then kind (its number in `rules`).

    Null and empty texts have none. Every row is judged by itself: repeated rows and null ids
    are no special case; an empty table stays empty. A column with the name `into` is replaced.
    """
    queries = Queries.of(rules)
    own = take(docs, doc_id="doc_id", text="text")
    found = keep(candidates(postings(own, queries), queries))
    found = F.broadcast(found) if found.count() <= BROADCAST_CANDIDATES else found
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), docs["text"].alias("text"), F.xxhash64(docs["doc_id"], docs["text"]).alias("key"))
    marked = rows.join(found, "key", "left")
    nothing = F.array().cast(_SPAN)
    each = []
    for i, rule in enumerate(rules):
        asked = F.coalesce(F.getbit("rules", F.lit(i)), F.lit(0)) == 1 if i in queries.masks else F.lit(True)
        each.append(F.when(asked & F.col("text").rlike(rule.pattern), _spans(rule, i)).otherwise(nothing))
    return marked.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns) if c != into],
                         F.array_sort(F.concat(*each)).alias(into))


def told(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, i)) for i in range(len(BASE))]
    counts = [(F.size("spans") - n).cast("long").alias(f"n_{r.kind}") for n, r in zip(counts, BASE)]
    return found.select("doc_id", *counts, F.sha2(told(base, rules), 256).alias("base_sha256"),
                        told(F.col("spans"), rules).alias("spans"))


def redact(found: DataFrame, mark: str = "[secret]", spans: str = "spans") -> DataFrame:
    """`found`, with every span of the text replaced by `mark`; overlapping spans by one."""
    def add(so_far: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), so_far["at"] + 1, s["start"] - so_far["at"])
        fresh = F.concat(so_far["out"], between, F.lit(mark))
        return F.struct(F.greatest(so_far["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= so_far["at"], fresh).otherwise(so_far["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.when(F.size(spans) == 0, F.col("text")).otherwise(F.aggregate(
        spans, first, add, lambda x: F.concat(x["out"], F.substring(F.col("text"), x["at"] + 1, F.length("text")))))
    return found.select(*[clean.alias("text") if c == "text" else F.col(c) for c in found.columns])

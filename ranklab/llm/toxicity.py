"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade >= k) = sigmoid(weights . x - threshold_k): one weight vector for all ordered
thresholds. The features are character n-grams of words (word boundaries included)
that toxic documents use more often, by likelihood ratio over a bounded sample of
labelled documents; each counts by presence and by the root of its rate. How many of them are
used, and the penalty, is found by cross-validation inside the sample: in each fold the
n-grams are chosen and the weights fitted without the documents that are scored.

The labels only tell toxic from not. The grades of toxic training documents are thirds by the score
that a model gives which has not seen the document: grade 3 is what other toxic documents predict best.
So only P(grade >= 1) rests on labels; the grades above order documents by that evidence.
The reported severity is the expected grade, sum over k of P(grade >= k).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, take, words
from ranklab.llm.sample import labelled
from ranklab.session import keep

SAMPLE_ROWS = 8000     # labelled documents that the model is fitted on, at most
FEATURES = (40, 80, 150, 300, 600)     # n-grams in the model: one of these numbers
PENALTIES = (1e-4, 1e-3, 1e-2)
FOLDS = 3
FOLD_ROWS = 3000       # sample documents that decide on these two, at most
FOLD_STEPS = 250
LEAST_DOCS = 4         # toxic sample documents an n-gram occurs in
LENGTHS = (4, 5, 6, 7)
GRADES = 3             # above 0
RATE_SCALE = 4.0
TOXIC_FROM = 0.4       # P(grade >= 1) from which a document is called toxic
CACHED_WORDS = 200_000
CELLS = 100_000        # n-grams of documents, about, that a task holds before it hands them on


def grams(word: bytes) -> set[str]:
    """The word with its boundaries, and its n-grams."""
    s = f" {word.decode()} "
    return {s, *(s[i:i + n] for n in LENGTHS for i in range(len(s) - n + 1))}


def damped(own: list[bytes]) -> Counter:
    """n-gram -> log(1 + count) in one document, so that one repetitive document can't make a feature."""
    counts: Counter = Counter()
    for w, n in Counter(own).items():
        for g in grams(w):
            counts[g] += n
    return Counter({g: math.log1p(n) for g, n in counts.items()})


def select(sample: DataFrame, features: int = max(FEATURES), least: int = LEAST_DOCS) -> list[list[str]]:
    """The n-grams that set toxic documents apart most, by likelihood ratio: without each fold in turn, and of all."""
    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"gram": [], "toxic": [], "fold": [], "weight": []}
        for at, label, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = damped(words(text))
            out["gram"] += own
            out["weight"] += own.values()
            out["toxic"] += [label > 0] * len(own)
            out["fold"] += [at % FOLDS] * len(own)
            if len(out["gram"]) >= CELLS:
                yield out
                out = {name: [] for name in out}
        yield out

    cells = map_batches(sample, work, "gram string, toxic boolean, fold int, weight double")
    toxic, fold = F.col("toxic"), F.col("fold")
    counts = keep(cells.groupBy("gram").agg(*[c for f in range(FOLDS) for c in (
        F.sum(F.when(toxic & (fold == f), F.col("weight")).otherwise(0.0)).alias(f"a{f}"),
        F.sum(F.when(~toxic & (fold == f), F.col("weight")).otherwise(0.0)).alias(f"b{f}"),
        F.count_if(toxic & (fold == f)).alias(f"n{f}"))]))
    views = [[f for f in range(FOLDS) if f != out] for out in range(FOLDS)] + [list(range(FOLDS))]
    return [_best(counts, folds, features, least) for folds in views]


def _best(counts: DataFrame, folds: list[int], features: int, least: int) -> list[str]:
    part = counts.select("gram", *[sum((F.col(f"{c}{f}") for f in folds), F.lit(0)).alias(n) for c, n in (("a", "a"), ("b", "b"), ("n", "docs"))])
    total = part.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total["a"] or not total["b"]:
        return []
    a, b = F.col("a"), F.col("b")
    share = (a + b) / (total["a"] + total["b"])
    ratio = a * F.log(a / total["a"] / share) + F.when(b > 0, b * F.log(b / total["b"] / share)).otherwise(0.0)
    # n-grams with the same counts are mostly parts of one word: the longest stands for them
    best = part.where((F.col("docs") >= least) & (a / total["a"] > b / total["b"])).groupBy(
        F.round("a", 6), F.round("b", 6), "docs").agg(F.max_by("gram", F.struct(F.length("gram"), F.col("gram"))).alias("gram"),
                                                      F.max(F.round(ratio, 6)).alias("ratio"))
    return [r["gram"] for r in best.orderBy(F.desc("ratio"), "gram").limit(features).collect()]


@dataclass
class Features:
    index: dict[str, int]
    known: dict[bytes, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"index": self.index, "known": {}}

    def of(self, word: bytes) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            found = self.known[word] = tuple(self.index[g] for g in grams(word) & self.index.keys())
        return found

    def rates(self, own: list[bytes]) -> dict[int, float]:
        """The root of the rate of each n-gram in a document."""
        counts: dict[int, int] = {}
        for w, n in Counter(own).items():
            for i in self.of(w):
                counts[i] = counts.get(i, 0) + n
        size = max(1, len(own))
        return {i: RATE_SCALE * math.sqrt(n / size) for i, n in sorted(counts.items())}

    def __call__(self, own: list[bytes]) -> tuple[list[int], list[float]]:
        """Columns and values of a document's vector: which n-grams it has, then their rates."""
        rates, m = self.rates(own), len(self.index)
        return [*rates, *(m + i for i in rates)], [1.0] * len(rates) + [*rates.values()]


@dataclass
class Model:
    features: Features
    weights: np.ndarray
    thresholds: np.ndarray      # rising

    def exceed(self, own: list[bytes]) -> np.ndarray:
        """P(grade >= k), k from 1."""
        at, value = self.features(own)
        z = float(self.weights[at] @ np.array(value)) if at else 0.0
        return 1 / (1 + np.exp(self.thresholds - z))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int = GRADES, penalty: float = 1e-4, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient ascent with momentum on the cumulative-link likelihood.

    thresholds are a first one and positive gaps, so they stay in order.
    """
    n = max(1, len(grade))
    w, first, gaps = np.zeros(x.shape[1]), 2.0, np.zeros(grades - 1)
    speed = [np.zeros_like(w), 0.0, np.zeros_like(gaps)]
    rows = np.arange(len(grade))
    for _ in range(steps):
        limits = first + np.r_[0.0, np.cumsum(np.exp(gaps))]
        above = np.c_[np.ones(len(grade)), 1 / (1 + np.exp(np.clip(limits[None, :] - (x @ w)[:, None], -30, 30))), np.zeros(len(grade))]
        slope = above * (1 - above)
        likely = np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-9)
        by_z = (slope[rows, grade] - slope[rows, grade + 1]) / likely
        by_limit = np.zeros((len(grade), grades + 2))
        by_limit[rows, grade] -= slope[rows, grade] / likely
        by_limit[rows, grade + 1] += slope[rows, grade + 1] / likely
        g = by_limit[:, 1:grades + 1].sum(0) / n
        steps_now = [x.T @ by_z / n - penalty * w, g.sum(), np.array([g[k + 1:].sum() for k in range(grades - 1)]) * np.exp(gaps)]
        for i, d in enumerate(steps_now):
            speed[i] = 0.9 * speed[i] + 0.1 * d
        w, first, gaps = w + speed[0], first + speed[1], np.clip(gaps + speed[2], -5, 3)
    return w, first + np.r_[0.0, np.cumsum(np.exp(gaps))]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """From at most `rows` labelled documents that are not held out. Without both kinds of label every severity is 0."""
    sample = keep(labelled(docs, labels, "toxic", rows))
    lists = select(sample)
    features = Features({g: i for i, g in enumerate(sorted(set().union(*lists)))})

    def work(batch: pa.RecordBatch) -> dict:
        made = [features.rates(words(t)) for t in batch.column(2).to_pylist()]
        return {"at": batch.column(0), "label": batch.column(1), "columns": [list(m) for m in made], "cells": [list(m.values()) for m in made]}

    nothing = Model(Features({}), np.zeros(0), np.full(GRADES, np.inf))
    if not lists[-1]:
        return nothing
    got = map_batches(sample, work, "at long, label int, columns array<int>, cells array<double>").orderBy("at").collect()
    toxic, fold = np.array([r["label"] > 0 for r in got]), np.array([r["at"] % FOLDS for r in got])

    def matrix(grams: list[str]) -> np.ndarray:
        place = {features.index[g]: n for n, g in enumerate(grams)}
        x = np.zeros((len(got), 2 * len(grams)))
        for i, r in enumerate(got):
            own = [(place[c], v) for c, v in zip(r["columns"], r["cells"]) if c in place]
            x[i, [c for c, _ in own]] = 1.0
            x[i, [len(grams) + c for c, _ in own]] = [v for _, v in own]
        return x

    def unseen(size: int, penalty: float, among: np.ndarray) -> np.ndarray:
        """Each document's score by the model of the other folds."""
        z = np.zeros(len(got))
        for f in range(FOLDS):
            seen = among & (fold != f)
            if lists[f] and toxic[seen].any() and not toxic[seen].all():
                x = matrix(lists[f][:size])
                w, limits = fit_ordinal(x[seen], toxic[seen].astype(int), 1, penalty, FOLD_STEPS)
                z[fold == f] = x[fold == f] @ w - limits[0]
        return z

    few = np.arange(len(got)) < FOLD_ROWS
    size = max(FEATURES, key=lambda m: (_order(unseen(m, PENALTIES[0], few)[few], toxic[few]), -m))
    penalty = max(PENALTIES, key=lambda p: (_order(unseen(size, p, few)[few], toxic[few]), -p))
    z = unseen(size, penalty, np.ones(len(got), bool))
    grade = np.where(toxic, 1 + np.searchsorted(np.quantile(z[toxic], np.arange(1, GRADES) / GRADES), z, "left"), 0)
    grams = lists[-1][:size]
    return Model(Features({g: i for i, g in enumerate(grams)}), *fit_ordinal(matrix(grams), grade, penalty=penalty))


def _order(z: np.ndarray, toxic: np.ndarray) -> float:
    """How often a toxic document is above another one, to three digits."""
    if toxic.all() or not toxic.any():
        return 0.0
    rank = (np.searchsorted(np.sort(z), z, "left") + np.searchsorted(np.sort(z), z, "right") + 1) / 2
    n = toxic.sum()
    return round(float((rank[toxic].sum() - n * (n + 1) / 2) / (n * (len(z) - n))), 3)


def score(docs: DataFrame, model: Model, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """(doc_id, severity, grade, toxic) for every row: expected grade, likeliest grade, and whether P(grade >= 1) >= `toxic_from`.

    Null and empty texts have the severity of a text without any feature, which is near 0.
    Repeated rows and null ids are scored each; texts of any length are read whole; an empty
    table gives no rows; other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("severity", "double").add(
        "grade", "integer").add("toxic", "boolean")

    def work(batch: pa.RecordBatch) -> dict:
        above = np.array([model.exceed(words(t)) for t in batch.column(1).to_pylist()]).reshape(-1, GRADES)
        parts = np.c_[np.ones(len(above)), above] - np.c_[above, np.zeros(len(above))]
        return {"doc_id": batch.column(0), "severity": above.sum(1), "grade": parts.argmax(1), "toxic": above[:, 0] >= toxic_from}

    return map_batches(take(docs, doc_id="doc_id", text="text"), work, schema)

"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are hashed: n-grams of its form (letters, case, digits, marks,
blanks, runs of letters shortened), words, and signs of repetition. Term weights and
a truncated singular value decomposition come from a bounded sample of labelled
documents; their unit vectors, a few MB at most, go to every task. Each document is compared
with all of them, by exact cosines in blocks, and its score is the share of label 1 among the
nearest, weighted by similarity. Cosines are compared to nine digits, and of equal ones the earlier
training row is nearer, so that a score depends neither on the block nor on the partition.
The documents never move.
"""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ranklab.llm.common import map_batches, words
from ranklab.llm.sample import is_held_out, labelled
from ranklab.session import keep

SAMPLE_ROWS = 6000    # labelled documents that vote, at most
FORM, WORDS, SIGNS = 768, 256, 4
TERMS = FORM + WORDS + SIGNS
WORD_WEIGHT = 0.3     # words tell languages apart more than quality
RANK = 48             # latent dimensions
NEIGHBOURS = 25
SHARPNESS = 4         # a neighbour's weight is its similarity to this power
BLOCK = 512           # documents compared at once
UNITS = 10 ** 9       # a cosine counts in units of 1e-9
SPAN = 200            # tokens among which repeated ones are counted
GOOD = 0.7

# Form of a byte: 1 small letters and all beyond ASCII, 2 capitals, 3 digits, 4 blanks, 5 line ends, then one for each mark.
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_FORM = np.zeros(256, np.uint8)
_FORM[97:123] = _FORM[128:] = 1
_FORM[65:91], _FORM[48:58], _FORM[:33], _FORM[10] = 2, 3, 4, 5
_FORM[_MARKS] = np.arange(6, 6 + len(_MARKS))


def _repeated(tokens: list[bytes]) -> int:
    """Tokens that stood before in their stretch of SPAN tokens: as a rate the same for short and long texts."""
    return len(tokens) - sum(len(set(tokens[at: at + SPAN])) for at in range(0, len(tokens), SPAN))


def terms(text: str | None) -> np.ndarray:
    """Term counts of a text, logarithmic, per root of its length."""
    raw = (text or "").encode()
    out = np.zeros(TERMS, np.float32)
    if not raw.strip():
        return out
    form = _FORM[np.frombuffer(raw, np.uint8)].astype(np.int64)
    form = form[np.r_[True, (form[1:] != form[:-1]) | (form[1:] != 1)]]
    for n in (1, 2, 3):
        if len(form) >= n:
            code = sum(form[i: len(form) - n + 1 + i] << 6 * i for i in range(n)) + (n << 20)
            out[:FORM] += np.bincount((code * 0x9E3779B1 >> 7) % FORM, minlength=FORM)
    own = words(text)
    hashed = np.fromiter(map(zlib.crc32, own), np.int64, len(own)) % WORDS
    out[FORM:FORM + WORDS] = np.bincount(hashed, minlength=WORDS)
    tokens, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    out[-4:] = (sum(map(operator.eq, tokens, tokens[1:])), _repeated(tokens),
                len(lines) - len(set(lines)), sum(map(operator.eq, tokens, tokens[2:])))
    out = np.log1p(100 * out / max(10, len(tokens)))      # rates per hundred words
    out[FORM:FORM + WORDS] *= WORD_WEIGHT
    return out


@dataclass
class Model:
    weight: np.ndarray      # of each term
    base: np.ndarray        # TERMS x RANK
    vectors: np.ndarray     # of the labelled documents, unit length
    labels: np.ndarray
    prior: float            # share of label 1, the score of a text without terms

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.weight).astype(float) @ self.base
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, x: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        out = np.full(len(x), self.prior)
        there = x.any(1)
        if not len(self.labels) or not there.any():
            return out
        near = self.project(x[there]) @ self.vectors.T
        rows, k = near.shape[1], min(neighbours, near.shape[1])
        far = np.rint((1 - near) * UNITS).astype(np.int64) * rows + np.arange(rows)     # no two are equal
        top = np.sort(np.partition(far, k - 1, axis=1)[:, :k], axis=1)
        vote = np.maximum(1 - (top // rows) / UNITS, 0) ** SHARPNESS
        total = vote.sum(1)
        out[there] = np.where(total > 0, (vote * self.labels[top % rows]).sum(1) / np.maximum(total, 1e-300), self.prior)
        return np.clip(np.round(out, 9), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, rank: int = RANK) -> Model:
    """From at most `rows` labelled documents that are not held out; without labels every score is 0.5."""
    def work(batch: pa.RecordBatch) -> dict:
        return {"at": batch.column(0), "label": batch.column(1), "terms": [terms(t).tobytes() for t in batch.column(2).to_pylist()]}

    sample = map_batches(keep(labelled(docs, labels, "quality", rows)), work, "at long, label int, terms binary").orderBy("at").collect()
    x = np.array([np.frombuffer(r["terms"], np.float32) for r in sample]).reshape(-1, TERMS)
    y = np.array([r["label"] for r in sample], float)
    there = (x > 0).sum(0)
    weight = np.where(there > 0, np.log((1 + len(x)) / (1 + there)) + 0.5, 0).astype(np.float32)
    weighted = (x * weight).astype(float)
    values, vectors = np.linalg.eigh(weighted.T @ weighted)        # of TERMS x TERMS
    base = vectors[:, np.argsort(values)[::-1][:rank]]
    base = base * np.where(base[np.abs(base).argmax(0), np.arange(base.shape[1])] < 0, -1, 1)   # one sign
    model = Model(weight, base, np.zeros((0, rank)), y, float(y.mean()) if len(y) else 0.5)
    if len(y):
        model.vectors = model.project(x)
    return model


def score(docs: DataFrame, model: Model, good: float = GOOD) -> DataFrame:
    """`docs`, all columns, and held_out, score, predicted (1 from `good` on).

    Null and empty texts, and texts of blanks alone, have the share of label 1 in the sample as score.
    Very long texts are read whole. Of equally near training rows the earlier one votes. Repeated rows and
    null ids (never held out) are scored each; an empty table gives no rows; the named columns are replaced.
    """
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rest = F.struct(F.lit(0).alias("_"), *[docs[c].alias(f"c{i}") for i, c in enumerate(kept) if c != "text"])
    rows = docs.select(rest.alias("rest"), docs["text"].alias("text"), is_held_out(docs["doc_id"]).alias("held_out"))
    schema = T.StructType(list(rows.schema.fields)).add("score", "double").add("predicted", "integer")

    def work(batch: pa.RecordBatch) -> dict:
        texts, scores = batch.column(1), []
        for at in range(0, len(texts), BLOCK):
            block = np.array([terms(t) for t in texts[at: at + BLOCK].to_pylist()]).reshape(-1, TERMS)
            scores.append(model.score(block))
        found = np.concatenate([np.zeros(0), *scores])
        return {"rest": batch.column(0), "text": texts, "held_out": batch.column(2), "score": found, "predicted": found >= good}

    return map_batches(rows, work, schema).select(*[
        F.col("text") if c == "text" else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(kept)], "held_out", "score", "predicted")

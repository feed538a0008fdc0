"""Toxicity: a counterfactual-regularised linear classifier.

Features are the words of a text and their prefixes, hashed; those that differ most between toxic and other
labelled texts, and all identity terms, enter a logistic model.  Every labelled text with identity terms also
gets a counterfactual in which each term is swapped for another of its group; the squared change of
the logit between the two is penalised with weight ``SWAP_WEIGHT``.  So a neutral mention of a group does not
raise the score.  The model is fitted on at most ``MOST_LABELLED`` labelled documents and scores every
whole text.

Edge cases: a NULL or empty text has no features and scores the model's base rate; contradicting labels of an
id count as 1; without labels of both classes every score is the share of label 1 (0 without any); repeated
rows are scored each; an empty table gives an empty result.  Only id, text and labels are read, and
labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import slices, str_texts
from .labels import fold, training_texts

WORDS = re.compile(r"\w+")
SPACE = 1 << 20
PREFIXES = (4, 5, 6, 7)
MOST_LABELLED = 8000
MOST_FEATURES = 3000
LEAST_Z = 3.0
SWAP_WEIGHT, DECAY, STEPS, RATE = 5.0, 2e-4, 400, 0.05
_CACHED = 300_000

#: neutral terms for groups of people; the terms of one line can stand for each other
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"),
    ("gay", "straight", "lesbian", "bisexual", "queer"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "protestants", "atheists"),
    ("immigrants", "refugees", "foreigners", "citizens"), ("young", "old"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "flüchtlinge", "einwanderer"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés", "étrangers"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados", "extranjeros"),
)


class Features(dict):
    """Hashed features of a word: itself and its longer-cut prefixes."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > _CACHED:
            self.clear()
        names = ["w:" + word] + [f"p{n}:" + word[:n] for n in PREFIXES if len(word) >= n]
        found = self[word] = tuple(xxhash.xxh64_intdigest(x) % SPACE for x in names)
        return found

    def of(self, words: set[str]) -> np.ndarray:
        found: set[int] = set()
        for w in words:
            found.update(self[w])
        return np.fromiter(found, np.int64, len(found))


def swapped(words: set[str], groups: Sequence[Sequence[str]]) -> set[str] | None:
    """The words with each identity term replaced by the next of its group; None without any."""
    other = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if words.isdisjoint(other):
        return None
    return {other.get(w, w) for w in words}


class SwapModel:
    """Logistic model over a chosen set of hashed features; rows are arrays of feature numbers."""

    def __init__(self, rows: list[np.ndarray], swaps: list[np.ndarray | None], y: np.ndarray, always: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.0
        self.fitted = len(y) >= 10 and 0 < self.share < 1
        if not self.fitted:
            return
        self.chosen = self._choose(rows, y, always)
        at, col = self._flat(rows)
        n, d, positive = len(y), len(self.chosen), y > 0
        pairs = [(r, s) for r, s in zip(rows, swaps) if s is not None]
        own_at, own_col = self._flat([r for r, _ in pairs])
        swap_at, swap_col = self._flat([s for _, s in pairs])
        w, bias = np.zeros(d), float(np.log(self.share / (1 - self.share)))
        m, v, mb, vb = np.zeros(d), np.zeros(d), 0.0, 0.0
        for step in range(1, STEPS + 1):
            z = bias + np.bincount(at, w[col], minlength=n)
            err = (1 / (1 + np.exp(-z)) - positive) / n
            grad = np.bincount(col, err[at], minlength=d) + DECAY * w
            if pairs:
                change = np.bincount(own_at, w[own_col], minlength=len(pairs)) - np.bincount(swap_at, w[swap_col], minlength=len(pairs))
                pull = 2 * SWAP_WEIGHT * change / len(pairs)
                grad += np.bincount(own_col, pull[own_at], minlength=d) - np.bincount(swap_col, pull[swap_at], minlength=d)
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            mb, vb = 0.9 * mb + 0.1 * err.sum(), 0.999 * vb + 0.001 * err.sum() ** 2
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            bias -= RATE * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
        self.weights, self.bias = w, bias

    @staticmethod
    def _choose(rows: list[np.ndarray], y: np.ndarray, always: np.ndarray) -> np.ndarray:
        """Features of largest two-proportion z, and those that always enter; sorted."""
        one, zero = np.zeros(SPACE, np.int32), np.zeros(SPACE, np.int32)
        for r, t in zip(rows, y):  # a row holds a feature once
            (one if t > 0 else zero)[r] += 1
        n1, n0 = max(int((y > 0).sum()), 1), max(int((y == 0).sum()), 1)
        rate = (one + zero) / (n1 + n0)
        z = (one / n1 - zero / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-9)
        z[one + zero < 3] = 0
        best = np.argsort(-np.abs(z), kind="stable")[:MOST_FEATURES]
        return np.unique(np.concatenate((best[np.abs(z[best]) >= LEAST_Z], always)))

    def _flat(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.searchsorted(self.chosen, r[np.isin(r, self.chosen)]) for r in rows]
        at = np.repeat(np.arange(len(rows)), [len(f) for f in found])
        return at, np.concatenate(found) if found else np.empty(0, np.int64)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, left_out: int = 2, groups: Sequence[Sequence[str]] = IDENTITY_TERMS
) -> SwapModel:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for b in slices(batches):
            own, swap = [], []
            for t in str_texts(b, "text"):
                words = set(WORDS.findall(t.lower()))
                other = swapped(words, groups)
                own.append(np.sort(made.of(words)).astype(np.int32).tobytes())
                swap.append(None if other is None else np.sort(made.of(other)).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("label"), pa.array(own, pa.binary()), pa.array(swap, pa.binary())], ["key", "label", "own", "swap"])

    texts = training_texts(docs, labels, "toxic", folds, left_out, MOST_LABELLED)
    got = texts.mapInArrow(features, "key long, label int, own binary, swap binary").orderBy("key").limit(MOST_LABELLED).collect()
    # views of the collected bytes: nothing is copied
    rows = [np.frombuffer(r.own, np.int32) for r in got]
    swaps = [None if r.swap is None else np.frombuffer(r.swap, np.int32) for r in got]
    terms = Features().of({t for g in groups for t in g})
    return SwapModel(rows, swaps, np.array([r.label for r in got], np.float64), terms)


def score_toxicity(docs: DataFrame, model: SwapModel) -> DataFrame:
    """(doc_id, score) for every document."""
    chosen, weights = (model.chosen, model.weights.astype(np.float32)) if model.fitted else (None, None)
    bias, share, fitted = getattr(model, "bias", 0.0), model.share, model.fitted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        full = np.zeros(SPACE, np.float32)
        if fitted:
            full[chosen] = weights
        for b in slices(batches):
            if fitted:
                z = np.array([bias + float(full[np.sort(made.of(set(WORDS.findall(t.lower()))))].sum(dtype=np.float64)) for t in str_texts(b, "text")])
                score = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            else:
                score = np.full(b.num_rows, share)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    asked = docs.select("doc_id", "text")
    return asked.mapInArrow(run, T.StructType([asked.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

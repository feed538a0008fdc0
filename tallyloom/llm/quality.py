"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Words and runs of marks fall by hash into ``BUCKETS`` buckets.  Each bucket has a fixed sparse random index
vector; its context vector is the sum of the index vectors of its neighbours over all documents.  A task
sums its documents into one table of fixed size and the tables are added in two salted steps, so memory and
broadcast do not grow with the corpus.  A document is pooled to the mean and the spread of its words'
vectors and the mean step between neighbours (small where words repeat).  A numpy network with one
hidden layer is fitted on at most ``MOST_LABELLED`` labelled documents; part of them sets the
temperature that calibrates its probabilities.

Edge cases: a NULL or empty text pools to zeros and gets the score of that; contradicting labels of an id count
as 1; without labels of both classes every score is the share of label 1 (0.5 without any); repeated rows are
scored each; an empty table gives an empty result.  Only id, text and labels are read, and labels, language,
source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import LETTERS_OR_MARKS, free_name, slices, str_texts
from .labels import fold, training_texts

BUCKETS, DIMS, SIGNS = 8192, 32, 4
CHUNK = 256
SALTS = 16
MOST_LABELLED = 8000
HIDDEN, EPOCHS, RATE, DECAY = 24, 40, 0.01, 1e-4
_CACHED = 500_000


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    rng = np.random.default_rng(10)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :SIGNS]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, SIGNS))


class Buckets(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > _CACHED:
            self.clear()
        b = self[token] = xxhash.xxh64_intdigest(token) % BUCKETS
        return b

    def of(self, text: str) -> np.ndarray:
        return np.array([self[t] for t in LETTERS_OR_MARKS.findall(text)], np.int64)


def context_table(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIMS + 1): context sums of each bucket and its count of tokens, over all documents."""
    width = DIMS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors()
        buckets = Buckets()
        table = np.zeros(BUCKETS * width)
        for b in slices(batches, 128):
            for text in str_texts(b, "text"):
                t = buckets.of(text)
                if not len(t):
                    continue
                word, near = np.concatenate((t[:-1], t[1:])), np.concatenate((t[1:], t[:-1]))
                at = ((word * width)[:, None] + places[near]).ravel()
                np.add.at(table, at, signs[near].ravel())
                np.add.at(table, t * width + DIMS, 1.0)
        out = table.reshape(-1, CHUNK * width)
        used = np.nonzero(out.any(axis=1))[0]
        salt = int(xxhash.xxh64_intdigest(table.tobytes()) % SALTS)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(used, pa.int32()), "salt": pa.array([salt] * len(used), pa.int32()),
             "sums": pa.array([out[c].astype(np.int64).tobytes() for c in used], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, raw in zip(b.column("chunk").to_pylist(), b.column("sums").to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(raw, np.int64)
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array(list(sums), pa.int32()), "salt": pa.array([0] * len(sums), pa.int32()),
             "sums": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    schema = "chunk int, salt int, sums binary"
    parts = docs.select("text").mapInArrow(count, schema)
    parts = parts.repartition("chunk", "salt").mapInArrow(add, schema)
    parts = parts.repartition("chunk").mapInArrow(add, schema)
    table = np.zeros((BUCKETS // CHUNK, CHUNK * width))
    for row in parts.collect():  # BUCKETS x (DIMS + 1) numbers in all
        table[row.chunk] += np.frombuffer(row.sums, np.int64)
    return table.reshape(BUCKETS, width)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit context vectors, with the corpus mean taken out."""
    sums, n = table[:, :DIMS], table[:, DIMS:]
    mean = sums.sum(axis=0) / max(n.sum(), 1.0)
    v = sums / np.maximum(n, 1.0) - mean * (n > 0)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(vectors: np.ndarray, t: np.ndarray) -> np.ndarray:
    if not len(t):
        return np.zeros(3 * DIMS, np.float32)
    v = vectors[t]
    mean = v.mean(axis=0)
    step = np.abs(np.diff(v, axis=0)).mean(axis=0) if len(t) > 1 else np.zeros(DIMS, np.float32)
    return np.concatenate((mean, v.std(axis=0), step)).astype(np.float32)


class Network:
    """Standardised inputs, tanh layer, logistic output, temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.share = float(y.mean()) if len(y) else 0.5
        self.fitted = len(y) >= 10 and 0 < self.share < 1
        if not self.fitted:
            return
        rng = np.random.default_rng(10)
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5 :]
        self.middle, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
        z = ((x - self.middle) / self.scale).astype(np.float32)
        d = x.shape[1]
        w = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.array(np.log(self.share / (1 - self.share)))]
        w = [p.astype(np.float32) for p in w]
        m, s, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS):
            rng.shuffle(used)
            for at in range(0, len(used), 128):
                rows = used[at : at + 128]
                h = np.tanh(z[rows] @ w[0] + w[1])
                err = (1 / (1 + np.exp(-(h @ w[2] + w[3]))) - y[rows]).astype(np.float32) / len(rows)
                back = np.outer(err, w[2]) * (1 - h * h)
                grads = [z[rows].T @ back + DECAY * w[0], back.sum(axis=0), h.T @ err + DECAY * w[2], err.sum()]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    s[i] = 0.999 * s[i] + 0.001 * g * g
                    w[i] = w[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
        self.w, self.temperature = w, 1.0
        # temperature of least log loss on rows that the weights have not seen
        logit, target = self._logits(x[held]), y[held]
        if len(held):
            trials = np.exp(np.linspace(np.log(0.25), np.log(16), 60))
            losses = [np.mean(np.logaddexp(0, logit / t) - target * logit / t) for t in trials]
            self.temperature = float(trials[int(np.argmin(losses))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.middle) / self.scale
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -50, 50).astype(float)))


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, left_out: int = 0) -> tuple[np.ndarray, Network]:
    """Word vectors of all documents and the network of the labelled ones outside fold ``left_out``."""
    vectors = word_vectors(context_table(docs))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in slices(batches):
            rows = [pool(vectors, buckets.of(t)).tobytes() for t in str_texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), pa.array(rows, pa.binary())], ["key", "label", "x"])

    texts = training_texts(docs, labels, "quality", folds, left_out, MOST_LABELLED)
    got = texts.mapInArrow(features, "key long, label int, x binary").orderBy("key").limit(MOST_LABELLED).collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in got]).reshape(len(got), 3 * DIMS)
    return vectors, Network(x, np.array([r.label for r in got], np.float32))


def score_quality(docs: DataFrame, labels: DataFrame, column: str = "score", folds: int = 5, left_out: int = 0) -> DataFrame:
    """docs with the score of each row's ``text`` in ``column``."""
    vectors, network = fit_quality(docs, labels, folds, left_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in slices(batches):
            x = np.array([pool(vectors, buckets.of(t)) for t in str_texts(b, "text")]).reshape(b.num_rows, 3 * DIMS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(network.scores(x), pa.float64())], [*b.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score_quality(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least ``threshold``."""
    column = free_name(docs, "_score")
    return score_quality(docs, labels, column).filter(F.col(column) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])

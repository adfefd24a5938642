"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated scores.

Every word (letters and digits, or a run of signs) falls into one of `buckets` hashed buckets. Each bucket has a fixed sparse random
index vector; the word vector of a bucket is the sum of the index vectors of the words around its occurrences, over all
documents. Tasks sum their own documents into a table of fixed size and the tables are added by bucket, so neither memory nor
the number of rows per task depends on the vocabulary. The vectors are scaled to length 1 and broadcast (buckets x width floats).

A document's features are the mean and the spread of its words' vectors, over occurrences and over distinct words, and how much its
words and neighbours repeat. A network of two layers is fitted in numpy on at most `max_labels` labelled documents, drawn
by a hash of the id; a part of them sets the temperature that makes the probabilities calibrated.

Only the text makes the score. Defined results: null and empty texts have all features 0 and the score of that. Labels of
one document that disagree, and null ones, are not used. Without labels of both kinds every score is the share of label 1 (0.5
with none). Null ids are never held out. Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import per_batch, texts_of, worker_cache

BUCKETS, WIDTH, NONZERO, WINDOW = 8_192, 32, 2, 2
MAX_LABELS = 20_000
THRESHOLD = 0.3
_KEPT = 500_000
_SIGN = re.compile(rb"[!-/:-@\[-`{-~]+")


class Pieces(dict):
    """White-space-free piece -> bucket of its word and of its signs (-1: none), packed in one integer; case is told apart
    by a bucket of its own for pieces in capitals."""

    def __missing__(self, piece: bytes) -> int:
        if len(self) > _KEPT:
            self.clear()
        word = _SIGN.sub(b"", piece)
        signs = b"".join(_SIGN.findall(piece))
        capital = len(word) > 1 and word.upper() == word and word.lower() != word
        w = xxhash.xxh3_64_intdigest(b"\x01" if capital else word.lower()) % BUCKETS + 1 if word else 0
        s = xxhash.xxh3_64_intdigest(b"\x02" + signs) % BUCKETS + 1 if signs else 0
        value = self[piece] = w << 20 | s
        return value


def buckets_of(text: bytes) -> np.ndarray:
    """Bucket numbers in reading order."""
    pieces = text.split()
    known = worker_cache("quality-pieces", Pieces)
    packed = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
    both = np.column_stack([packed >> 20, packed & 0xFFFFF]).ravel()
    return both[both > 0] - 1


def index_vectors(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, WIDTH, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def context_sums(ids: np.ndarray, total: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to total[bucket] the index vectors of the words within WINDOW places; -1 in ids ends a text."""
    for step in range(1, WINDOW + 1):
        for a, b in ((ids[:-step], ids[step:]), (ids[step:], ids[:-step])):
            held = (a >= 0) & (b >= 0)
            x, y = a[held], b[held]
            for k in range(NONZERO):
                total += np.bincount(x * WIDTH + places[y, k], weights=signs[y, k], minlength=total.size).reshape(total.shape)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = index_vectors()
    total = np.zeros((BUCKETS, WIDTH))
    gap = np.full(WINDOW, -1)
    waiting, n = [], 0
    for batch in batches:
        for text in texts_of(batch.column(0)):
            ids = buckets_of(text)
            waiting += [ids, gap]
            n += len(ids)
            if n > 500_000:
                context_sums(np.concatenate(waiting), total, places, signs)
                waiting, n = [], 0
    if n:
        context_sums(np.concatenate(waiting), total, places, signs)
    used = np.flatnonzero(np.abs(total).sum(axis=1))
    yield pa.record_batch(
        [pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))], ["bucket", "context"]
    )


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The vectors of all buckets, learned from all documents: BUCKETS x WIDTH floats on the driver."""
    parts = docs.select(text).mapInArrow(_contexts, "bucket bigint, context array<double>")
    summed = parts.groupBy("bucket").agg(*[F.sum(F.col("context")[k]).alias(f"c{k}") for k in range(WIDTH)])
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    for row in summed.collect():
        out[row[0]] = row[1:]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


N_FEATURES = 4 * WIDTH + 5


def features(text: bytes, vectors: np.ndarray) -> np.ndarray:
    ids = buckets_of(text)
    if not len(ids):
        return np.zeros(N_FEATURES, np.float32)
    kinds, counts = np.unique(ids, return_counts=True)
    v = vectors[kinds]
    share = (counts / len(ids)).astype(np.float32)
    mean, plain = share @ v, v.mean(axis=0)
    spread = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
    plain_spread = np.sqrt(np.maximum((v * v).mean(axis=0) - plain * plain, 0))
    repeats = [
        float(share.max()),
        float((share * share).sum()),
        len(kinds) / len(ids),
        float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0,
        np.log1p(len(ids)) / 10.0,
    ]
    return np.concatenate([mean, spread, plain, plain_spread, np.array(repeats, np.float32)]).astype(np.float32)


class Net:
    """tanh layer and logistic output, with inputs standardised; float64 throughout."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 11):
        self.hidden = None
        self.base = float(y.mean()) if len(y) else 0.5
        if len(set(y.tolist())) < 2:
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        fold = rng.permutation(len(y))
        n_fit = max(1, int(len(y) * 0.8))
        fit, tune = fold[:n_fit], fold[n_fit:]
        x = (x - self.mean) / self.scale
        self.hidden = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden))
        self.bias, self.out, self.shift = np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)
        weights = [self.hidden, self.bias, self.out, self.shift]
        m, v, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        size = min(128, len(fit))
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // size)):
                a = x[rows]
                h = np.tanh(a @ self.hidden + self.bias)
                d = (1 / (1 + np.exp(-np.clip(h @ self.out + self.shift, -40, 40))) - y[rows]) / len(rows)
                back = np.outer(d, self.out) * (1 - h * h)
                grads = [a.T @ back + 1e-4 * self.hidden, back.sum(axis=0), h.T @ d + 1e-4 * self.out, np.array([d.sum()])]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    weights[k] -= 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.temperature = 1.0
        self.temperature = self._calibrated(x[tune], y[tune]) if len(set(y[tune].tolist())) == 2 else 1.0

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh(x @ self.hidden + self.bias) @ self.out + self.shift) / self.temperature

    def _calibrated(self, x: np.ndarray, y: np.ndarray) -> float:
        """The temperature with the least log loss."""
        z = self._logit(x)
        loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
        return min(np.exp(np.linspace(np.log(0.5), np.log(8), 60)), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.hidden is None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self._logit((x - self.mean) / self.scale), -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _feature_column(vectors, text: Column):
    def of(column: pa.Array) -> pa.Array:
        return pa.array([features(t, vectors.value) for t in texts_of(column)], pa.list_(pa.float32()))

    return per_batch(of, pa.list_(pa.float32()))(text)


def quality_column(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, text: str = "text", doc_id: str = "doc_id") -> Column:
    """The score column for the text of docs; learns word vectors from docs and the network from labels not held out."""
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text))
    agreed = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where((F.col("quality") == F.col("most")) & ~held_out(F.col("doc_id")))
        .select("doc_id", "quality")
    )
    drawn = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(drawn), "doc_id")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))  # one row per labelled id
    rows = known.select("quality", _feature_column(vectors, F.col("text")).alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, N_FEATURES)
    net = spark.sparkContext.broadcast(Net(x, np.array([r["quality"] for r in rows], np.float64)).__dict__)
    name = f"quality-{uuid.uuid4().hex}"

    def restored() -> Net:
        out = Net.__new__(Net)
        out.__dict__ = net.value
        return out

    def score(column: pa.Array) -> pa.Array:
        model, out = worker_cache(name, restored), []
        texts = texts_of(column)
        for start in range(0, len(texts), 256):
            out.append(model.score(np.array([features(t, vectors.value) for t in texts[start : start + 256]])))
        return pa.array(np.concatenate(out) if out else np.empty(0), pa.float64())

    return per_batch(score, pa.float64())(docs[text])


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """One row per document: score (near 1: label 1), and 1 or 0 as it reaches the threshold."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_column(docs, labels, **how).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

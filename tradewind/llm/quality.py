"""Quality scores from random-indexing word vectors and a small network.

Method: words, hashed to a fixed number of places, have sparse random index vectors; a word's vector
is its own index vector and the scaled sum of the index vectors of the words around it in the whole
corpus. A document is the pooled vector of its words, frequent words weighing less. A two-layer
network is fitted to a bounded sample of labelled documents, and its probabilities are calibrated by
a temperature fitted on documents that the network did not see.

The corpus pass adds up whole numbers, so its result depends neither on partitions nor on order. Its
size is fixed (``PLACES`` rows); only that table and the vectors of the sample reach the driver.

Defined results: a null, empty or wordless text has the zero vector and a score like any other; rows
without label (null, or no row in ``labels``) teach nothing; of several labels of one id the smallest
counts, of several texts of one labelled id the smallest vector teaches; without both classes among the labels every score is the share of label 1 (0.5 without
labels); repeated rows are scored each by itself; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField

from .common import append_columns, fresh, pieces, stored, text_bytes
from .words import tokens

PLACES = 4096
DIMENSIONS = 48
NONZERO = 4
REACH = 2
#: At most so many labelled documents fit the network, chosen by a hash of their ids.
MOST_LABELLED = 20_000
HIDDEN = 32
SEED = 42
LIMIT = 0.3
_LEAST_SHARE = 1e-3


def index_vectors(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(dimension, sign) of the nonzero entries of each place's index vector; the last place marks a repeated word."""
    rng = np.random.default_rng(seed)
    at = rng.random((PLACES + 1, DIMENSIONS)).argsort(axis=1)[:, :NONZERO]
    return at.astype(np.int64), rng.choice(np.array([-1, 1], np.int64), (PLACES + 1, NONZERO))


def places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(place, text number) of every word and sign run; a word that repeats the word before it takes the last place."""
    hashes, _, doc, _ = tokens(texts, lower=False)
    place = (hashes % np.uint64(PLACES)).astype(np.int64)
    if len(place) > 1:
        place[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])] = PLACES
    return place, doc


def context_sums(texts: list[bytes], sums: np.ndarray, counts: np.ndarray, at: np.ndarray, sign: np.ndarray) -> None:
    """Add the texts' neighbours to ``sums`` and their words to ``counts``."""
    place, doc = places(texts)
    counts += np.bincount(place, minlength=PLACES + 1)
    for reach in range(1, REACH + 1):
        left, right = place[:-reach], place[reach:]
        same = doc[:-reach] == doc[reach:]
        left, right = left[same], right[same]
        for one, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                sums += np.bincount(one * DIMENSIONS + at[other, k], weights=sign[other, k], minlength=sums.size).astype(np.int64)


def corpus_sums(docs: DataFrame, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(counts, context sums) of every place over all documents; a table of fixed size."""
    at, sign = index_vectors(seed)
    names = [f"d{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((PLACES + 1) * DIMENSIONS, np.int64), np.zeros(PLACES + 1, np.int64)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in pieces(texts):
                context_sums(texts[a:b], sums, counts, at, sign)
        used, table = np.flatnonzero(counts), sums.reshape(-1, DIMENSIONS)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), *(pa.array(table[used, i]) for i in range(DIMENSIONS))], names=["place", "n", *names])

    partial = docs.select("text").mapInArrow(run, ", ".join(f"{n} long" for n in ["place", "n", *names]))
    rows = partial.groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names]).toPandas()
    counts, sums = np.zeros(PLACES + 1, np.int64), np.zeros((PLACES + 1, DIMENSIONS), np.int64)
    counts[rows["place"]] = rows["n"]
    sums[rows["place"]] = rows[names].to_numpy(np.int64)
    return counts, sums


def word_vectors(counts: np.ndarray, sums: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Vectors of the places, scaled by their weight in a pooled document."""
    at, sign = index_vectors(seed)
    own = np.zeros((PLACES + 1, DIMENSIONS))
    np.add.at(own, (np.arange(PLACES + 1)[:, None], at), sign)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    vectors = own / np.sqrt(NONZERO) + sums / np.maximum(length, 1)
    share = counts / max(counts.sum(), 1)
    weight = _LEAST_SHARE / (_LEAST_SHARE + share)
    weight[PLACES] = 1.0
    return (vectors * weight[:, None]).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One vector a text: the sum of its words' vectors over the number of its words."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    place, doc = places(texts)
    for a in range(0, len(texts), 256):
        b = min(a + 256, len(texts))
        lo, hi = np.searchsorted(doc, (a, b))
        tally = np.bincount((doc[lo:hi] - a) * (PLACES + 1) + place[lo:hi], minlength=(b - a) * (PLACES + 1)).reshape(b - a, -1)
        out[a:b] = (tally.astype(np.float32) @ vectors) / np.maximum(tally.sum(axis=1, keepdims=True), 1)
    return out


class Network:
    """Two layers on standardised vectors, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED, rounds: int = 60):
        self.base = float(y.mean()) if len(y) else 0.5
        self.constant = len(np.unique(y)) < 2
        if self.constant:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        aside, fit = order[: len(y) // 5], order[len(y) // 5:]
        if len(np.unique(y[fit])) < 2 or len(aside) < 10:
            fit, aside = order, order
        self.mean, self.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        d = x.shape[1]
        self.p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for turn in range(rounds):
            for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
                step += 1
                h = np.maximum(x[batch] @ self.p[0] + self.p[1], 0)
                z = h @ self.p[2] + self.p[3]
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
                back = np.outer(g, self.p[2]) * (h > 0)
                grads = [x[batch].T @ back, back.sum(axis=0), h.T @ g, np.array([g.sum()])]
                rate = 0.005 * (1 - turn / rounds) + 1e-5
                for i, grad in enumerate(grads):
                    grad = grad + 1e-4 * self.p[i] * (i % 2 == 0)
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad**2
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        z, target = self._logits(x[aside]), y[aside]
        trials = np.geomspace(0.5, 8, 61)
        losses = [np.mean(np.logaddexp(0, z / t) - target * z / t) for t in trials]
        self.temperature = float(trials[int(np.argmin(losses))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.base)
        z = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def teaching(labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """(doc_id, label) of the rows that may teach: labelled, and not of the fold that is held out."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold != held))
    return known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))


def sampled(known: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the rows, the same ones on every run."""
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def vectors_of(docs: DataFrame, vectors: np.ndarray, name: str) -> DataFrame:
    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = text_bytes(batch.column(0))
        parts = [pooled(texts[a:b], vectors) for a, b in pieces(texts)]
        flat = np.concatenate(parts) if parts else np.zeros((0, DIMENSIONS), np.float32)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * DIMENSIONS), pa.array(flat.reshape(-1)))]

    return append_columns(docs, ["text"], [StructField(name, ArrayType(FloatType()))], make)


def scored(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED, seed: int = SEED, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """(the columns to keep, all by default, and the score; the score's name): fitted to ``known(doc_id, label)``.

    The kept columns, among them ``doc_id``, are written once with the pooled vectors.
    """
    vector, score = fresh(docs, "vector", "score")
    vectors = word_vectors(*corpus_sums(docs, seed), seed)
    pooled_docs = stored(vectors_of(docs, vectors, vector).select(*(keep or docs.columns), vector), "pooled")
    chosen = sampled(known, most).withColumnRenamed("doc_id", "chosen_id")
    lesson = pooled_docs.select(F.col("doc_id").alias("chosen_id"), F.col(vector).alias("x")).join(F.broadcast(chosen), "chosen_id")
    rows = lesson.groupBy("chosen_id", "label").agg(F.min("x").alias("x")).toPandas().sort_values("chosen_id")
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), DIMENSIONS)
    network = Network(x, rows["label"].to_numpy(np.float64), seed)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        x = batch.column(0).values.to_numpy(zero_copy_only=False) if batch.num_rows else np.zeros(0)
        return [pa.array(network.score(x.reshape(batch.num_rows, DIMENSIONS).astype(np.float64)), pa.float64())]

    return append_columns(pooled_docs, [vector], [StructField(score, DoubleType())], make).drop(vector), score

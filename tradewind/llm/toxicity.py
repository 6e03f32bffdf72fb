"""Toxicity scores that do not hang on which group a sentence names.

Method: a logistic model over the presence of words and word beginnings. Sentences of labelled
documents that name a group are copied with the name swapped for another of its kind, and the
squared difference between a sentence's and its copy's log-odds is a penalty in training, so that a
name as such neither raises nor lowers a score and neutral mentions are not flagged.

Words are hashed to places. Of the places that occur in a bounded sample of labelled documents those
that tell the classes apart best are features; names always are. The sample, the sentence pairs and
the features have fixed bounds, so what is broadcast or reaches the driver does not grow with the data.

Defined results: a null or empty text has the score of a text without features; rows without label
teach nothing; of several labels of one id the smallest counts; with only one class among the labels
every score is the share of label 1 (0.5 without labels); repeated rows are scored each by itself;
texts of any length are read whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from ..session import staged
from .common import append_columns, fresh, pieces, text_bytes
from .quality import sampled
from .words import distinct, tokens

PLACES = 1 << 20
PREFIX = 6
FEATURES = 16_384
LEAST_DOCUMENTS = 3
#: A feature's presence differs between the classes by so much at least; chance alone seldom does.
LEAST_CHI = 10.0
MOST_LABELLED = 20_000
MOST_PAIRS = 20_000
PENALTY = 4.0
RIDGE = 2e-4
ROUNDS = 300
LIMIT = 0.3
#: Names of groups, by kind; the first of a kind is the neutral one.
NAMES = (
    ("people", "women", "men", "girls", "boys", "females", "males"),
    ("person", "woman", "man", "girl", "boy", "female", "male"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "catholics", "protestants", "atheists", "mormons"),
    ("believer", "muslim", "christian", "jew", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist", "mormon"),
    ("human", "black", "white", "asian", "arab", "african", "european", "latino", "hispanic", "indian", "chinese", "mexican", "roma"),
    ("adults", "gays", "lesbians", "bisexuals", "straights", "transgender", "queer", "gay", "lesbian", "bisexual", "straight"),
    ("residents", "immigrants", "refugees", "foreigners", "natives", "migrants"),
    ("patients", "disabled", "blind", "deaf", "autistic", "elderly", "young", "old"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "schwarze", "weiße", "ausländer", "flüchtlinge", "schwule", "lesben"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "noirs", "blancs", "étrangers", "réfugiés", "homosexuels", "lesbiennes"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "negros", "blancos", "extranjeros", "refugiados", "homosexuales", "lesbianas"),
)
_KIND = {name: kind for kind, names in enumerate(NAMES) for name in names}
_NAME = re.compile(r"\b(" + "|".join(sorted(map(re.escape, _KIND), key=len, reverse=True)) + r")\b", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]+")


def swapped(sentence: str) -> str:
    """The sentence with each name replaced by the next one of its kind; the last gives way to the neutral one."""
    def other(m: re.Match) -> str:
        names = NAMES[_KIND[m[0].lower()]]
        return names[(names.index(m[0].lower()) + 1) % len(names)]

    return _NAME.sub(other, sentence)


def pairs_of(text: str) -> list[tuple[str, str]]:
    """The text's sentences that name a group, with their swapped copies."""
    if not _NAME.search(text):
        return []
    return [(s, swapped(s)) for s in _SENTENCE.findall(text) if _NAME.search(s)]


def present(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place): every place that a text's words and word beginnings have, once a text."""
    hashes, kind, doc, begins = tokens(texts, True, PREFIX)
    letters = kind == 1
    place = np.concatenate([hashes[letters], begins[letters]]) % np.uint64(PLACES)
    both = distinct(np.concatenate([doc[letters]] * 2).astype(np.uint64) * np.uint64(PLACES) + place)
    return (both // np.uint64(PLACES)).astype(np.int64), (both % np.uint64(PLACES)).astype(np.int64)


def name_places() -> np.ndarray:
    return np.unique(present([name.encode() for name in _KIND])[1])


def _listed(doc: np.ndarray, place: np.ndarray, n: int) -> pa.Array:
    offsets = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32)))


def lessons(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, pair, side, places): a line for each chosen document (pair -1), two for each sentence pair."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    rows = docs.select("doc_id", text).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, raw = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            lines = [(i, y, -1, 0, t) for i, y, t in zip(ids, labels, raw)]
            lines += [(i, y, k, side, s) for i, y, t in zip(ids, labels, raw) for k, both in enumerate(pairs_of(t)) for side, s in enumerate(both)]
            texts = [x[4].encode() for x in lines]
            for a, b in pieces(texts):
                head = list(zip(*[x[:4] for x in lines[a:b]]))
                yield pa.RecordBatch.from_arrays([pa.array(head[0], pa.int64()), *(pa.array(h, pa.int32()) for h in head[1:]), _listed(*present(texts[a:b]), b - a)],
                                                 names=["doc_id", "label", "pair", "side", "places"])

    return rows.mapInArrow(run, "doc_id long, label int, pair int, side int, places array<int>")


def chosen_features(lines: DataFrame, total: int, positive: int, features: int = FEATURES) -> np.ndarray:
    """The places whose presence differs most between the classes, by the chi-square of two by two, and the names."""
    counts = lines.filter("pair = -1").select("label", F.explode("places").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k"))
    share = positive / max(total, 1)
    difference = F.col("k") - F.col("n") * share
    chi = difference * difference / (F.col("n") * (1 - F.col("n") / F.lit(float(total + 1))) * max(share * (1 - share), 1e-9))
    best = counts.filter((F.col("n") >= LEAST_DOCUMENTS) & (chi >= LEAST_CHI)).orderBy(chi.desc(), "place").limit(features)
    return np.unique(np.concatenate([best.select("place").toPandas()["place"].to_numpy(np.int64), name_places()]))


class Model:
    """Logistic weights of the features; ``table`` maps a place to its feature's weight."""

    def __init__(self, places: np.ndarray, base: float):
        self.places, self.weights, self.bias = places, np.zeros(len(places)), float(np.log(base / (1 - base))) if 0 < base < 1 else 0.0
        self.constant = None if 0 < base < 1 else base

    def _rows(self, lists: list) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        place = np.concatenate([np.asarray(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)
        at = np.searchsorted(self.places, place)
        kept = (at < len(self.places)) & (self.places[np.minimum(at, len(self.places) - 1)] == place)
        return row[kept], at[kept]

    def fit(self, lists: list, y: np.ndarray, left: list, right: list, penalty: float = PENALTY, rounds: int = ROUNDS) -> None:
        if self.constant is not None:
            return
        row, at = self._rows(lists)
        (row_l, at_l), (row_r, at_r) = self._rows(left), self._rows(right)
        w, b, n = self.weights, self.bias, len(y)
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for step in range(1, rounds + 1):
            z = np.bincount(row, w[at], n) + b
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
            grad = np.bincount(at, g[row], len(w)) + 2 * RIDGE * w / 10
            if len(left):
                apart = np.bincount(row_l, w[at_l], len(left)) - np.bincount(row_r, w[at_r], len(left))
                apart *= 2 * penalty / len(left)
                grad += np.bincount(at_l, apart[row_l], len(w)) - np.bincount(at_r, apart[row_r], len(w))
            rate = 0.1 * (1 - step / (rounds + 1))
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            mb, vb = 0.9 * mb + 0.1 * g.sum(), 0.999 * vb + 0.001 * g.sum() ** 2
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
            b = b - rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-6)
        self.weights, self.bias = w, float(b)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        table = np.zeros(PLACES)
        table[self.places] = self.weights
        z = np.full(len(texts), self.bias)
        for a, b in pieces(texts):
            doc, place = present(texts[a:b])
            z[a:b] += np.bincount(doc, table[place], b - a)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def trained(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED, penalty: float = PENALTY, features: int = FEATURES) -> Model:
    chosen = sampled(known, most)
    lines = staged(lessons(docs, chosen), "lessons")
    total, positive = lines.filter("pair = -1").agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    places = chosen_features(lines, total, positive, features)
    model = Model(places, positive / total if total else 0.5)
    used = F.broadcast(lines.sparkSession.createDataFrame([(int(p),) for p in places], "place int"))
    kept = lines.withColumn("line", F.monotonically_increasing_id())
    slim = kept.select("line", F.explode("places").alias("place")).join(used, "place").groupBy("line").agg(F.collect_list("place").alias("places"))
    whole = kept.drop("places").join(slim, "line", "left").withColumn("places", F.coalesce("places", F.array().cast("array<int>")))
    rows = whole.filter("pair = -1").select("doc_id", "label", "places").toPandas().sort_values("doc_id")
    both = whole.filter("pair >= 0").groupBy("doc_id", "pair").agg(F.max(F.when(F.col("side") == 0, F.col("places"))).alias("left"), F.max(F.when(F.col("side") == 1, F.col("places"))).alias("right"))
    both = both.orderBy(F.xxhash64("doc_id", "pair"), "doc_id", "pair").limit(MOST_PAIRS).toPandas()
    model.fit(rows["places"].tolist(), rows["label"].to_numpy(np.float64), both["left"].tolist(), both["right"].tolist(), penalty)
    return model


def scored(docs: DataFrame, known: DataFrame, most: int = MOST_LABELLED, penalty: float = PENALTY, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """(the columns to keep, all by default, and the score; the score's name): fitted to ``known(doc_id, label)``."""
    model = trained(docs, known, most, penalty)
    (score,) = fresh(docs, "score")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(model.score(text_bytes(batch.column(0))), pa.float64())]

    return append_columns(docs, ["text"], [StructField(score, DoubleType())], make).select(*(keep or docs.columns), score), score

"""Training documents that hold test items.

Method: test items, and their questions and answers (the last sentence) where these have ``PART``
words or more, are cut into segments of at most ``SEGMENT`` words. The segments are the documents of an
inverted index with BM25 weights, each weight divided by what the segment scores against itself. Every passage
of every training document, a window of ``PASSAGE`` words that starts every ``STRIDE`` words, is a
query: all segments that reach the threshold are retrieved. As in block-max WAND, postings carry the
largest weight in the index and in each block of segments; a passage is dropped when its words' index
maxima cannot reach the threshold, then block by block, and only what remains is scored from the
postings. A passage longer than a segment by the stride holds some window around any whole segment.
Items that were retrieved are verified on the whole document by the shares of their five-word shingles
that it holds: an item leaks if 0.8 of it are held, or 0.8 of its question or of its answer, where that
part has ``PART`` words or more. A shorter part is too common to tell by itself.

Postings and verification run where the documents are read, so no text is shuffled. The index is sent
to the tasks in shards of about ``SHARD_BYTES`` of item text. Term counts and the mean length come from
all items, so scores do not depend on the shards. A larger benchmark takes one pass a shard: what a
shard finds is written before the next one is fetched, and one index is held at a time.

Defined results: a null, empty or wordless text leaks nothing; an item without words (null, empty) is
in no document; items and documents of fewer than five words count as one shingle; repeated rows and
ties are each reported; several items with one text are each reported; of other columns, whatever
their names, none is read; an empty table on either side gives no leaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from ..session import staged
from .common import append_columns, fresh, pieces, stored, text_bytes
from .words import distinct, mixed, tokens

SEGMENT, PASSAGE, STRIDE = 32, 64, 32
SHINGLE = 5
#: Words from which a question or an answer tells by itself.
PART = 13
LIKE = 0.8
THRESHOLD = 0.6
K1, B = 1.2, 0.75
#: Segments of a block; more, once there are more than ``BLOCKS`` blocks.
BLOCK, BLOCKS = 8, 128
SHARD_BYTES = 16 << 20
_SLACK = 1e-5
_ANSWER = re.compile(r"(?<=[.!?:])\s+(?=\S)|\n+")


def question_and_answer(text: str) -> tuple[str, str]:
    """The text before its last sentence or line, and that; a single sentence is all question."""
    parts = [m.end() for m in _ANSWER.finditer(text.rstrip())]
    return (text[: parts[-1]], text[parts[-1]:]) if parts else (text, "")


def word_runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words in lower case without signs, offsets of the texts)."""
    hashes, kind, doc, _ = tokens(texts, True)
    words = kind == 1
    return hashes[words], np.searchsorted(doc[words], np.arange(len(texts) + 1))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words; of the whole, if it is shorter."""
    n = min(SHINGLE, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + words[i: len(words) - n + 1 + i])
    return total


def answer_words(text: str) -> int:
    return len(word_runs([question_and_answer(text)[1].encode()])[0])


def segments_of(words: np.ndarray, answer: int) -> list[np.ndarray]:
    """The segments of an item whose last ``answer`` words are its answer.

    Of the longer parts, and of the whole unless these make up 0.8 of it: a text that holds 0.8 of
    the whole then holds about as much of one of them.
    """
    question = len(words) - answer
    runs = [part for part in (words[:question], words[question:]) if len(part) >= PART]
    if sum(map(len, runs)) < LIKE * len(words):
        runs.append(words)
    return [cut for run in runs for cut in np.array_split(run, -(-len(run) // SEGMENT))]


class Statistics(NamedTuple):
    """Of all items: how many segments there are, their mean length, and in how many of them each term is."""

    segments: int
    length: float
    terms: np.ndarray
    counts: np.ndarray


class Index:
    """BM25 postings of the items' segments with maxima, and the items' shingles; weighed by ``whole``, else by these items alone."""

    def __init__(self, ids: list, texts: list[str], whole: Statistics | None = None):
        words, at = word_runs([t.encode() for t in texts])
        kept = [i for i in range(len(texts)) if at[i + 1] > at[i]]
        self.ids = [ids[i] for i in kept]
        self.parts, self.tells = [], []
        runs, self.item = [], []
        for new, i in enumerate(kept):
            own = words[at[i]: at[i + 1]]
            answer = answer_words(texts[i])
            all_shingles = shingles(own)
            border = max(len(own) - answer - min(SHINGLE, len(own)) + 1, 0) if answer < len(own) else len(all_shingles)
            self.parts.append((np.unique(all_shingles), np.unique(all_shingles[:border]), np.unique(all_shingles[len(own) - answer:]) if answer >= SHINGLE else np.zeros(0, np.uint64)))
            self.tells.append((True, len(own) - answer >= PART, answer >= PART))
            for run in segments_of(own, answer):
                runs.append(run)
                self.item.append(new)
        self.item = np.array(self.item, np.int64)
        self.terms, inverse = np.unique(np.concatenate(runs) if runs else np.zeros(0, np.uint64), return_inverse=True)
        segment = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        code, tf = np.unique(inverse.astype(np.int64) * max(len(runs), 1) + segment, return_counts=True)
        term, self.segment = code // max(len(runs), 1), code % max(len(runs), 1)
        length = np.array([len(r) for r in runs], float)
        if whole is None:
            whole = Statistics(len(runs), length.mean() if len(runs) else 1, self.terms, np.bincount(term, minlength=len(self.terms)))
        df = whole.counts[np.searchsorted(whole.terms, self.terms)]
        idf = np.log(1 + (whole.segments - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / max(whole.length, 1))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.segment])
        own_score = np.bincount(self.segment, weight, len(runs))
        self.weight = weight / own_score[self.segment]
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(self.weight, self.start[:-1]) if len(term) else np.zeros(0)
        # blocks of segments of like length, whose weights are alike; the largest weight of each term in each block
        count = len(runs)
        place = np.empty(count, np.int64)
        place[np.argsort(length, kind="stable")] = np.arange(count)
        self.block = place // max(BLOCK, -(-count // BLOCKS))
        self.block_most = np.zeros((len(self.terms), int(self.block.max()) + 1 if count else 1), np.float32)
        np.maximum.at(self.block_most, (term, self.block[self.segment]), self.weight.astype(np.float32))

    def _expanded(self, group: np.ndarray, term: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every (group, term) all postings of the term: (group, posting)."""
        counts = start[term + 1] - start[term]
        ends = np.cumsum(counts)
        posting = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(start[term], counts)
        return np.repeat(group, counts), posting

    def retrieve(self, words: np.ndarray, at: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, item, best score) of every item of which some passage reaches the threshold."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if not len(self.terms) or not len(words):
            return none
        found = np.searchsorted(self.terms, words)
        found[found == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[found] == words)
        if not len(known):
            return none
        term = found[known].astype(np.int64)
        doc = np.searchsorted(at, known, side="right") - 1
        place = known - at[doc]
        windows = np.diff(at) // STRIDE + 1
        first = np.cumsum(windows) - windows
        window = first[doc] + place // STRIDE
        earlier = place >= STRIDE
        n, blocks = len(self.terms), self.block_most.shape[1]
        code = distinct(np.concatenate([window, window[earlier] - 1]) * n + np.concatenate([term, term[earlier]]))
        window, term = code // n, code % n
        # index maxima, then block maxima
        left = np.bincount(window, self.most[term])[window] >= threshold - _SLACK
        window, term = window[left], term[left]
        if not len(window):
            return none
        starts = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
        line, block = np.nonzero(np.add.reduceat(self.block_most[term], starts, axis=0) >= threshold - _SLACK)
        if not len(line):
            return none
        open_pairs = window[starts][line] * blocks + block
        left = np.isin(window, distinct(window[starts][line]))
        window, term = window[left], term[left]
        # full scores
        group, posting = self._expanded(window, term, self.start)
        left = np.isin(group * blocks + self.block[self.segment[posting]], open_pairs)
        group, posting = group[left], posting[left]
        segments = len(self.item)
        pair, inverse = np.unique(group * segments + self.segment[posting], return_inverse=True)
        score = np.bincount(inverse, self.weight[posting], len(pair))
        hit = score >= threshold - _SLACK
        doc = np.searchsorted(first, pair[hit] // segments, side="right") - 1
        key, inverse = np.unique(doc * len(self.ids) + self.item[pair[hit] % segments], return_inverse=True)
        best = np.zeros(len(key))
        np.maximum.at(best, inverse, score[hit])
        return key // len(self.ids), key % len(self.ids), best

    def leaks(self, texts: list[bytes]) -> list[list[tuple]]:
        """Per text the verified items: (item id, score, question overlap, answer overlap)."""
        words, at = word_runs(texts)
        out: list[list[tuple]] = [[] for _ in texts]
        doc, item, best = self.retrieve(words, at)
        for d in np.unique(doc):
            held = np.unique(shingles(words[at[d]: at[d + 1]]))
            for i, score in zip(item[doc == d], best[doc == d]):
                share = [float(np.isin(p, held, assume_unique=True).mean()) if len(p) else None for p in self.parts[i]]
                if any(s is not None and tells and s >= LIKE for s, tells in zip(share, self.tells[i])):
                    out[d].append((self.ids[i], float(score), share[1], share[2]))
        return out


LEAK = ArrayType(StructType([StructField("item_id", LongType()), StructField("score", DoubleType()), StructField("question_overlap", DoubleType()), StructField("answer_overlap", DoubleType())]))
_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def _found(docs: DataFrame, index: Index) -> tuple[DataFrame, str]:
    """(all columns and the verified leaks of each row, the leaks' name)."""
    (name,) = fresh(docs, "leaks")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = text_bytes(batch.column(0))
        names = ("item_id", "score", "question_overlap", "answer_overlap")
        rows = [[dict(zip(names, leak)) for leak in one] for a, b in pieces(texts, 2 << 20) for one in index.leaks(texts[a:b])]
        return [pa.array(rows, _LEAK)]

    return append_columns(docs, ["text"], [StructField(name, LEAK)], make), name


def _segment_terms(items: DataFrame) -> DataFrame:
    """(shard, length, terms): one row for each segment of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards, lengths, terms = [], [], []
            for shard, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist()):
                words, _ = word_runs([text.encode()])
                for segment in segments_of(words, answer_words(text)) if len(words) else []:
                    shards.append(shard)
                    lengths.append(len(segment))
                    terms.append(np.unique(segment).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int64()))], names=["shard", "length", "terms"])

    return items.select("shard", "text").mapInArrow(run, "shard long, length long, terms array<long>")


def _indexes(items: DataFrame, shard_bytes: int) -> Iterator[tuple[Index, bool]]:
    """(the index of one shard of the items, whether it is the last), one after the other."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    texts = texts.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    segments = staged(_segment_terms(texts), "benchmark-terms")
    count, length = segments.agg(F.count("*"), F.coalesce(F.avg("length"), F.lit(1.0))).first()
    terms = segments.select("shard", F.explode("terms").alias("term"))
    counts = staged(terms.distinct().join(terms.groupBy("term").agg(F.count("*").alias("n")), "term"), "benchmark-counts")
    for shard in range(shards):
        rows = texts.filter(F.col("shard") == shard).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        known = counts.filter(F.col("shard") == shard).select("term", "n").toArrow()
        own = known["term"].to_numpy().view(np.uint64)
        order = np.argsort(own)
        whole = Statistics(count, length, own[order], known["n"].to_numpy()[order])
        yield Index([r["item_id"] for r in rows], [r["text"] for r in rows], whole), shard == shards - 1


def leaks(docs: DataFrame, items: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): one row for each item that a document holds."""
    parts = []
    for index, last in _indexes(items, shard_bytes):
        found, name = _found(docs.select("doc_id", "text"), index)
        rows = found.select("doc_id", F.explode(name).alias("leak")).select("doc_id", "leak.*")
        parts.append(rows if last else staged(rows, "leaks"))
    return reduce(DataFrame.unionAll, parts)


def clean(docs: DataFrame, items: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents that hold no test item; each shard is asked only about what the shards before it left."""
    left = docs
    for index, last in _indexes(items, shard_bytes):
        found, name = _found(left, index)
        left = found.filter(F.size(name) == 0).select(*docs.columns)
        left = left if last else stored(left, "clean")
    return left

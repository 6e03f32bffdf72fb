"""Token ids as compressed files.

Method: documents are dealt to ranges of their ids and sorted; a task turns its texts into ids, ends
each document with an end id, and cuts the stream into frames of whole documents. A frame's ids are
coded in blocks of a fixed length, each with its own model, reset, and its own checksum
(``idcoder``), under the shares of the frame's ids. A frame is one row of the file table: place (part,
frame), those shares, the documents' ids and lengths, the blocks' sizes and checksums, and the coded
bytes, so any frame, and any block of it, can be read alone. Spark's committer writes the files; an executor that is lost costs its tasks only.

Defined results: a null text is an empty one, which has the end id only; null doc_ids come first;
rows with equal ids are dealt to tasks and ordered by their texts' hash, repeated rows are documents of their own; very
long texts are one frame; an empty table gives files without frames and no rows; only ``doc_id`` and
``text`` are read, so other columns may have any name. A block whose checksum is wrong raises.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import idcoder
from .common import pieces

END = 2
#: Ids after which a frame is closed; what is left, if fewer, goes with the last one. The coder takes all blocks of a frame at once, so it costs less an id in a large one.
FRAME_IDS = 1 << 22
#: A task encodes texts of about so many bytes at once, so that each new piece is met once in them, and cuts so many characters at once.
TEXTS, CUT = 16 << 20, 1 << 20
#: Remembered pieces are dropped beyond so many.
MOST_PIECES = 1 << 20
#: Unknown pieces that the library is given as one text, and texts that it is given at once.
WORDS, GROUPS = 256, 64
#: Byte-level vocabularies of this family cut a text into the pieces
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SPACE, LETTER, NUMBER = r"\s", r"\p{L}", r"\p{N}"
SHORT, LONG = "stmd", ("re", "ve", "ll")
FRAMES = ("part int, frame int, prior binary, doc_ids array<long>, doc_lengths array<long>, "
          "block_lengths array<int>, block_bytes array<int>, block_checksums array<long>, payload binary")
DOCUMENTS = "part int, frame int, doc_id long, first long, n_tokens long, ids_crc32 long"


@cache
def _kinds() -> np.ndarray:
    """Of every code point: 1 space, 2 letter, 3 number, 0 anything else."""
    every = np.arange(0x110000, dtype="<u4")
    every[0xD800:0xE000] = 0  # no text has surrogates
    every, out = every.tobytes().decode("utf-32-le"), np.zeros(0x110000, np.uint8)
    for kind, what in enumerate((SPACE, LETTER, NUMBER), 1):
        for run in regex.finditer(f"{what}+", every):
            out[run.start(): run.end()] = kind
    return out


def _cuts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that follow each other; ``first`` marks where the texts begin."""
    kind = _kinds().take(points)
    turns = first.copy()
    turns[1:] |= kind[1:] != kind[:-1]
    begins = turns.copy()
    # the last space of several is a piece by itself, and a blank goes with what follows it
    last = np.flatnonzero((kind[:-1] == 1) & turns[1:] & ~first[1:])
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    # 's and the like are cut off what follows
    marks = np.flatnonzero(points[:-1] == 39)
    marks = marks[begins[marks] & ~first[marks + 1] & (kind[marks + 1] == 2)]
    if len(marks):
        padded = np.append(points, [0, 0])
        one, two, whole = padded[marks + 1], padded[marks + 2], ~np.append(first, [True, True])[marks + 2]
        short = np.isin(one, [ord(c) for c in SHORT])
        long = np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in LONG]) & whole
        cut = marks[short | long]
        begins[cut + 1] = False
        ends = np.append(marks[short] + 2, marks[long] + 3)
        begins[ends[ends < len(points)]] = True
    return np.flatnonzero(begins)


@cache
def _letters() -> np.ndarray:
    """The code points that stand for bytes in byte-level vocabularies."""
    kept = np.r_[33:127, 161:173, 174:256]
    out = np.zeros(256, "<u2")
    out[kept] = kept
    out[out == 0] = 256 + np.arange(256 - len(kept))
    return out


class Encoder:
    """Ids of whole texts by the tokenizers library, whose model is asked once for each distinct piece.

    Pieces are remembered as one Arrow array, without a Python object each, so a worker may keep them from task to task.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = Tokenizer(self.library.model)  # for texts that are cut and spelt in letters already
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        vocabulary = self.library.get_vocab()
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.starts, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u4")

    def _ids(self, unknown: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has: an id stands for a known number of bytes, and none for bytes of two pieces."""
        ends = np.cumsum([len(p) for p in unknown])
        spelt, at = _letters().take(np.frombuffer(b"".join(unknown), np.uint8)).tobytes().decode("utf-16-le"), [0, *ends.tolist()]
        words = [spelt[a:b] for a, b in zip(at[:-1], at[1:])]
        ids = [np.zeros(0, "<u4")]
        for start in range(0, len(words), WORDS * GROUPS):  # what the library returns takes much memory
            asked = words[start: start + WORDS * GROUPS]
            found = self.model.encode_batch_fast([asked[i:i + WORDS] for i in range(0, len(asked), WORDS)], is_pretokenized=True, add_special_tokens=False)
            ids.append(np.fromiter(chain.from_iterable(f.ids for f in found), "<u4"))
        ids = np.concatenate(ids)
        stands = np.cumsum(self.n_bytes[ids])
        last = np.searchsorted(stands, ends)
        if len(stands) == 0 or stands[-1] != ends[-1] or (stands[last] != ends).any():  # not of this family
            return self._ids_one_by_one(unknown)
        return ids, np.diff(last, prepend=-1)

    def _ids_one_by_one(self, unknown: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [f.ids for f in self.library.encode_batch_fast([p.decode() for p in unknown], add_special_tokens=False)]
        return np.array(list(chain.from_iterable(found)), "<u4"), np.array([len(ids) for ids in found], np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self._cut(texts[start:stop]) for start, stop in pieces(texts, CUT)]
        places, at, out = self._places([found for found, _ in cut]), 0, []
        n_ids, end = np.diff(self.starts), np.array([END], "<u4")
        for found, n_pieces in cut:
            place = places[at: at + len(found)]
            at += len(found)
            counts = n_ids.take(place)
            held = np.append(0, np.cumsum(counts))
            flat = self.ids.take(np.repeat(self.starts.take(place) - held[:-1], counts) + np.arange(held[-1]))
            bounds = held[np.append(0, np.cumsum(n_pieces))].tolist()
            out += [np.concatenate([flat[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:])]
        del cut, places
        pa.default_memory_pool().release_unused()  # the coder needs much next
        return out

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts as UTF-8, one text after another, and how many each text has."""
        parts, owner, whole = texts, None, None
        joined = "".join(texts)
        if any(s in joined for s in self.specials):
            cut = [self.special.split(t) for t in texts]
            parts = [p for c in cut for p in c]
            owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
            whole = np.concatenate([np.arange(len(c)) % 2 == 1 for c in cut])
        if not joined:
            return self.known[:0], np.zeros(len(texts), np.int64)
        lengths = np.array([len(p) for p in parts], np.int64)
        begins = np.cumsum(lengths) - lengths
        first = np.zeros(len(joined), bool)
        first[begins[lengths > 0]] = True
        cuts = _cuts(np.frombuffer(joined.encode("utf-32-le"), "<u4"), first)
        if whole is not None:  # a special text is one piece
            part = np.searchsorted(begins, cuts, side="right") - 1
            cuts = cuts[~whole[part] | (cuts == begins[part])]
        n_pieces = np.diff(np.searchsorted(cuts, np.append(begins, len(joined))))
        if owner is not None:
            n_pieces = np.bincount(owner, n_pieces, len(texts)).astype(np.int64)
        encoded = joined.encode("utf-8")
        raw = np.frombuffer(encoded, np.uint8)
        at = cuts if len(raw) == len(joined) else np.flatnonzero((raw & 0xC0) != 0x80)[cuts]
        offsets = pa.py_buffer(np.append(at, len(raw)).astype(np.int64))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, offsets, pa.py_buffer(encoded)]), n_pieces

    def _places(self, found: list[pa.Array]) -> np.ndarray:
        """Which remembered piece each piece is; those that are new are encoded and remembered."""
        if len(self.known) > MOST_PIECES:
            self._forget()
        n = len(self.known)
        # what is remembered comes first, each piece once, so it keeps its places and new pieces get those behind
        seen = pa.chunked_array([a for a in (self.known, *found) if len(a)], pa.large_binary()).dictionary_encode().chunks
        if seen and len(seen[0].dictionary) > n:
            self.known = seen[0].dictionary
            new, specials = self.known[n:].to_numpy(zero_copy_only=False).tolist(), {s.encode() for s in self.specials}
            special = np.array([p in specials for p in new])
            lengths, parts = np.zeros(len(new), np.int64), []
            runs = np.flatnonzero(np.diff(special, prepend=not special[0])).tolist()
            for start, stop in zip(runs, [*runs[1:], len(new)]):
                ids, lengths[start:stop] = (self._ids_one_by_one if special[start] else self._ids)(new[start:stop])
                parts.append(ids)
            self.ids = np.concatenate([self.ids, *parts])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        return np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in seen)])[n:]


@cache
def _encoder(path: str) -> Encoder:
    """The worker's encoder, which all its tasks share."""
    return Encoder(path)


def _frame(part: int, frame: int, doc_ids: list, ids: list[np.ndarray]) -> dict:
    stream = np.concatenate(ids)
    blocks = [stream[i:i + idcoder.BLOCK] for i in range(0, len(stream), idcoder.BLOCK)]
    prior = idcoder.Prior.of(blocks)
    coded = idcoder.encode(blocks, prior)
    return {"part": part, "frame": frame, "prior": prior.to_bytes(), "doc_ids": doc_ids, "doc_lengths": [len(x) for x in ids],
            "block_lengths": [len(b) for b in blocks], "block_bytes": [len(c) for c in coded],
            "block_checksums": [idcoder.checksum(b) for b in blocks], "payload": b"".join(coded)}


def _frame_type() -> pa.Schema:
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.schema([("part", pa.int32()), ("frame", pa.int32()), ("prior", pa.binary()), ("doc_ids", longs), ("doc_lengths", longs),
                      ("block_lengths", ints), ("block_bytes", ints), ("block_checksums", longs), ("payload", pa.binary())])


def write(docs: DataFrame, folder: str, path: str, frame_ids: int = FRAME_IDS) -> None:
    """Write the ids of all documents, in the order of doc_id, as files below ``folder``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, frame, encoder = TaskContext.get().partitionId(), 0, _encoder(path)
        doc_ids, ids, held, full, full_held = [], [], 0, 0, 0

        def row(n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_frame(part, frame, doc_ids[:n], ids[:n])], _frame_type())

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for start, stop in pieces(texts.cast(pa.binary()).to_pylist(), TEXTS):
                for key, one in zip(keys[start:stop], encoder.encode(texts.slice(start, stop - start).to_pylist())):
                    doc_ids.append(key)
                    ids.append(one)
                    held += len(one)
                    if not full and held >= frame_ids:
                        full, full_held = len(ids), held
                    # a full frame is written when another one is there, so that the last one is no short one
                    if full and held - full_held >= frame_ids:
                        yield row(full)
                        doc_ids, ids, held, full, frame = doc_ids[full:], ids[full:], held - full_held, 0, frame + 1
                        if held >= frame_ids:
                            full, full_held = len(ids), held
        if doc_ids:
            yield row(len(doc_ids))

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    order = ("doc_id", F.xxhash64("text"))  # the hash lets a common or null id take more than one task
    sorted_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_docs.mapInArrow(run, FRAMES).write.parquet(folder)


def read(spark, folder: str) -> DataFrame:
    """The files' frames."""
    return spark.read.schema(FRAMES).parquet(folder)


def ids_of(frame: dict) -> np.ndarray:
    """The ids of one frame, every block decoded and held against its checksum."""
    ends = np.cumsum(frame["block_bytes"])
    coded = [frame["payload"][e - n: e] for e, n in zip(ends, frame["block_bytes"])]
    blocks = idcoder.decode(coded, frame["block_lengths"], idcoder.Prior.from_bytes(frame["prior"]))
    wrong = [i for i, (b, c) in enumerate(zip(blocks, frame["block_checksums"])) if idcoder.checksum(b) != c]
    if wrong:
        raise ValueError(f"part {frame['part']}, frame {frame['frame']}: damaged blocks {wrong}")
    return np.concatenate(blocks) if blocks else np.zeros(0, "<u4")


def documents(frames: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the decoded files.

    ``start`` counts the ids before a document in all files: before its frame by the frames' totals,
    summed within a part and over parts, and before it in its frame.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                frame = batch.slice(i, 1).to_pylist()[0]
                ids, lengths = ids_of(frame), np.array(frame["doc_lengths"], np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(ids[e - n: e].tobytes()) for e, n in zip(ends, lengths)]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, frame["part"], np.int32)), pa.array(np.full(n, frame["frame"], np.int32)), pa.array(frame["doc_ids"], pa.int64()),
                    pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())], names=["part", "frame", "doc_id", "first", "n_tokens", "ids_crc32"])

    size = F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = frames.select("part", "frame", size.alias("size"))
    earlier = Window.partitionBy("part").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    in_part = sizes.select("part", "frame", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("in_part"))
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))  # one row a task that wrote
    before = parts.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = in_part.join(before, "part").select("part", "frame", (F.col("in_part") + F.col("before")).alias("base"))
    found = frames.mapInArrow(run, DOCUMENTS).join(starts, ["part", "frame"])
    return found.select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def written(docs: DataFrame, path: str, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write the documents' ids to a fresh folder, read the files back, and tell what is in them."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    write(docs, folder, path, frame_ids)
    return documents(read(docs.sparkSession, folder))

"""Byte-level BPE by the tokenizers library over Arrow batches, and back.

Method: a rank file is turned into a vocabulary of the tokenizers library: every byte is mapped to one printable
character, every token to the string of its bytes' characters, and each token's merge is found by merging its own bytes by the lower
ranks until two parts are left. (A token that no merges lead to is still found where it is a whole piece.) Texts are cut into
pieces by the given pattern, and each piece is encoded on its own; a batch asks the library once for each distinct piece. Offsets follow
from the tokens' byte lengths: a token covers every character of which it holds a byte, so the tokens of a split character all cover it.
Decoding looks up the characters of each id, maps them back to bytes and joins these before it reads them as UTF-8, so characters that were split
over tokens are whole again; what is no UTF-8 becomes U+FFFD in the text and stays as it is in the bytes.

No row needs another: nothing is shuffled. The vocabulary is compiled once by the driver and travels with the tasks; its size is that of the rank file.

Defined results: a null or empty text has no tokens; null ids decode to nothing; names of special tokens inside texts are ordinary text; repeated
rows get equal results; texts of any length are encoded whole; an empty table gives no rows; other columns pass unchanged, whatever their names; ids that the vocabulary
lacks raise.
"""

from __future__ import annotations

import base64
import json
import os
from codecs import getincrementaldecoder
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from .common import fresh

#: Pieces that are remembered: of so many characters at most, so many of them.
LONGEST_PIECE, MOST_PIECES = 64, 1 << 18
#: Texts that are worked on at a time.
TEXTS = 256


def byte_characters() -> list[str]:
    """One printable character for every byte: those that print stand for themselves, the others follow U+0100 in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + others.index(b)) for b in range(256)]


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the merges below a token's own rank leave of it, if they leave two."""
    own, parts = ranks[token], [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1)]
        rank, i = min(found)
        if rank >= own:
            return None
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def compiled(path: str) -> str:
    """The rank file as a vocabulary of the library, serialised."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    shown = byte_characters()
    write = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [merge_of(token, ranks) for token in sorted(ranks, key=ranks.get) if len(token) > 1]
    model = models.BPE(vocab={write[t]: r for t, r in ranks.items()}, merges=[(write[m[0]], write[m[1]]) for m in merges if m], ignore_merges=True)
    library = Tokenizer(model)
    library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return library.to_str()


class Encoder:
    def __init__(self, vocabulary: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.cut = Tokenizer.from_str(vocabulary), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > MOST_PIECES:
            self.known.clear()
        missing = list(set().union(*cut).difference(self.known))
        found = self.library.encode_batch_fast(missing, add_special_tokens=False)
        self.known.update((piece, np.array(f.ids, "<i4").tobytes()) for piece, f in zip(missing, found))
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), "<i4") for pieces in cut]
        for piece in missing:
            if len(piece) > LONGEST_PIECE:
                del self.known[piece]
        return out


class Decoder:
    def __init__(self, vocabulary: str):
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = json.loads(vocabulary)["model"]["vocab"]
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in vocab.items()}
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, held in self.bytes_of.items():
            self.lengths[i] = len(held)

    def decode(self, ids: np.ndarray) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        except KeyError as error:
            raise ValueError(f"no token has the id {error.args[0]}") from None

    def token_texts(self, ids: np.ndarray) -> list[str]:
        """What each token adds to the text; a character that was split comes with its last token."""
        read = getincrementaldecoder("utf-8")("replace").decode
        held = [self.decode(ids[i:i + 1]) for i in range(len(ids))]
        return [read(b, final=i == len(held) - 1) for i, b in enumerate(held)]

    def offsets(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token's first character and the one after its last, in code points."""
        ends = np.cumsum(self.lengths[ids])
        place = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1  # of the character that a byte belongs to
        return place[ends - self.lengths[ids]], place[ends - 1] + 1


def _lists(parts: list[np.ndarray]) -> pa.Array:
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32)))


def _with_columns(docs: DataFrame, read: str, fields: list[StructField], make: Callable[[pa.Array], list[pa.Array]], drop: bool = False) -> DataFrame:
    """The table and the columns that ``make`` derives from one, which goes with ``drop``; worked on in pieces of ``TEXTS`` rows, so that a task holds few of them."""
    kept = [c for c in docs.columns if not (drop and c == read)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                piece = batch.slice(start, TEXTS)
                yield pa.RecordBatch.from_arrays([*piece.select(kept).columns, *make(piece.column(read))], names=[*kept, *[f.name for f in fields]])

    return docs.mapInArrow(run, StructType([*[docs.schema[c] for c in kept], *fields]))


def encoded(docs: DataFrame, path: str, pattern: str, offsets: bool = True, drop: bool = False) -> tuple[DataFrame, list[str]]:
    """All columns (with ``drop`` without ``text``) and its ids, and with ``offsets`` each token's borders in code points; the new names."""
    vocabulary, names = compiled(path), fresh(docs, *["ids", "starts", "ends"][: 3 if offsets else 1])
    made: dict[str, object] = {}

    def make(column: pa.Array) -> list[pa.Array]:
        if not made:
            made["encoder"], made["decoder"] = Encoder(vocabulary, pattern), Decoder(vocabulary) if offsets else None
        texts = ["" if t is None else t for t in column.to_pylist()]
        ids = made["encoder"].encode(texts)
        if not offsets:
            return [_lists(ids)]
        borders = [made["decoder"].offsets(t.encode(), i) for t, i in zip(texts, ids)]
        return [_lists(ids), _lists([b[0] for b in borders]), _lists([b[1] for b in borders])]

    return _with_columns(docs, "text", [StructField(n, ArrayType(IntegerType())) for n in names], make, drop), names


def decoded(docs: DataFrame, ids: str, path: str, text: bool = True) -> tuple[DataFrame, list[str]]:
    """All columns and the bytes that the ids stand for, and with ``text`` their text; the new names."""
    vocabulary, names = compiled(path), fresh(docs, *["decoded", "decoded_text"][: 2 if text else 1])
    made: dict[str, Decoder] = {}

    def make(column: pa.Array) -> list[pa.Array]:
        if not made:
            made["decoder"] = Decoder(vocabulary)
        flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        held = [made["decoder"].decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return [pa.array(held, pa.binary()), *([pa.array([h.decode("utf-8", "replace") for h in held], pa.string())] if text else [])]

    return _with_columns(docs, ids, [StructField(n, t) for n, t in zip(names, [BinaryType(), StringType()])], make), names

"""Token counts by a compiled finite-state transducer.

Method: byte-pair encoding is turned into a deterministic transducer over bytes. The encoding of a
prefix ends in exactly one token whose pairing with the token before it is stable; a state holds the
bytes that a longer token could still take in, with the last token and the relative count at each
place where such a token could start, so the number of states is finite. A transition carries how many tokens the encoding
gains. States and transitions are compiled when a word first needs them, within a bound. A text is
cut into chunks; a chunk's state map is (head, count, tail): white space resets the transducer, so
from its first white space on a chunk acts alike from every state, and only the head before it waits
for the state that comes in. Maps compose associatively and are folded by a parallel prefix scan's
pairwise tree.

Defined results: a null or empty text has 0 tokens and 0 bytes; ties and repeated rows are counted
each by itself; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so other columns
may have any name; texts of any length are counted whole.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from .common import append_columns, fresh

CHUNK = 1 << 16
#: Compiled transitions and remembered words are dropped and compiled anew beyond so many.
MOST_TRANSITIONS = 1 << 20
MOST_WORDS = 1 << 18


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Words(dict):
    """What whole words emit, remembered: paths through the transducer taken before."""

    def __init__(self, walk: Callable[[str], int]):
        self.walk = walk

    def __missing__(self, word: str) -> int:
        found = self.walk(word)
        self[word] = found
        return found


class Transducer:
    """Compiled from the merge table of a vocabulary whose words end in a marked symbol."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, symbols, mark = spec["model"], byte_symbols(), spec["model"]["end_of_word_suffix"]

        def key(token: str) -> tuple[bytes, bool]:
            last = token.endswith(mark) and token != mark
            return bytes(symbols[c] for c in (token[: -len(mark)] if last else token)), last

        self.number: dict[tuple[bytes, bool], int] = {(bytes([b]), last): b + 256 * last for b in range(256) for last in (False, True)}
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = (key(t) for t in (merge if isinstance(merge, list) else merge.split(" ")))
            whole = (left[0] + right[0], right[1])
            new = self.number.setdefault(whole, len(self.number))
            halves = (self.number[left], self.number[right])
            self.split.setdefault(new, halves)
            self.pair.setdefault(halves, new)
        self.inner = {text: n for (text, last), n in self.number.items() if not last}
        self.final = {text: n for (text, last), n in self.number.items() if last}
        self.prefixes = {text[:i] for text, _ in self.number for i in range(len(text))}
        self.stable: dict[tuple[int, int], bool] = {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.words = Words(self.word)
        self.forget()

    def forget(self) -> None:
        self.known: list[tuple] = [(b"", ((0, None, 0),))]
        self.states = {self.known[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.ends: dict[int, int] = {}
        self.words.clear()

    def keeps(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their texts stand side by side: undo merges in
        falling order and look for a merge across the border that would have come earlier."""
        found = self.stable.get((left, right))
        if found is None:
            if len(self.stable) > MOST_TRANSITIONS:
                self.stable.clear()
            found = self.stable[left, right] = self._keeps(left, right)
        return found

    def _keeps(self, left: int, right: int) -> bool:
        bound = 1 << 60
        while True:
            across = self.pair.get((left, right))
            if across is not None and across < bound:
                return False
            # the later of both merges is undone; equal ones merge from the left, so the right goes first
            if left > right and left in self.split:
                bound, left = left, self.split[left][1]
            elif right in self.split:
                bound, right = right + 1, self.split[right][0]
            elif left in self.split:
                bound, left = left, self.split[left][1]
            else:
                return True

    def _last(self, state: int, byte: int, tokens: dict[bytes, int]) -> tuple[bytes, int, int]:
        """The text so far with the byte, the token it ends in, and the gain in tokens."""
        tail, places = self.known[state]
        text = tail + bytes((byte,))
        for start, last, count in places:
            token = tokens.get(text[start:])
            if token is not None and (last is None or self.keeps(last, token)):
                return text, token, count + 1
        raise ValueError("the vocabulary lacks a byte")

    def step(self, state: int, byte: int) -> tuple[int, int]:
        text, token, gain = self._last(state, byte, self.inner)
        before = self.known[state][1]
        open_at = [i for i in range(len(text) + 1) if text[i:] in self.prefixes]  # where a later token can start
        first = open_at[0]
        places = [(start - first, last, count - gain) for start, last, count in before if start in open_at]
        new = (text[first:], (*places, (len(text) - first, token, 0)))
        number = self.states.get(new)
        if number is None:
            number = self.states[new] = len(self.known)
            self.known.append(new)
        self.steps[state << 8 | byte] = (number, gain)
        return number, gain

    def word(self, word: str) -> int:
        """Tokens of one word: the sum of what its transitions emit."""
        if len(self.words) > MOST_WORDS or len(self.steps) > MOST_TRANSITIONS:
            self.forget()
        data, state, total, steps = word.encode(), 0, 0, self.steps
        for byte in data[:-1]:
            state, gain = steps.get(state << 8 | byte) or self.step(state, byte)
            total += gain
        last = state << 8 | data[-1]
        gain = self.ends.get(last)
        if gain is None:
            gain = self.ends[last] = self._last(state, data[-1], self.final)[2]
        return total + gain


#: How the vocabulary's pre-tokeniser cuts words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
SPACE = regex.compile(r"\s")


def _lowered(text: str) -> str:
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def odd_characters(path: str) -> str:
    """Code points that the vocabulary's own normaliser treats in another way than ``_lowered``, which is several times faster."""
    from tokenizers import Tokenizer

    normal = Tokenizer.from_file(path).normalizer.normalize_str
    every = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and not chr(c).isspace()]

    def differing(chars: list[str]) -> list[str]:
        joined = " ".join(chars)
        if normal(joined) == _lowered(joined):
            return []
        return chars if len(chars) == 1 else differing(chars[: len(chars) // 2]) + differing(chars[len(chars) // 2:])

    return "".join(c for i in range(0, len(every), 4096) for c in differing(every[i:i + 4096]))


class Counter:
    """Counts tokens of whole texts by composing the state maps of their chunks.

    Texts with one of the ``odd`` characters are normalised by the vocabulary's own normaliser.
    """

    def __init__(self, path: str, odd: str | None = None):
        from tokenizers import Tokenizer

        self.machine, self.normal = Transducer(path), Tokenizer.from_file(path).normalizer.normalize_str
        odd = odd_characters(path) if odd is None else odd
        self.odd = regex.compile(f"[{''.join(map(regex.escape, odd))}]" if odd else r"(?!)")
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(self.machine.special, key=len, reverse=True)) or r"(?!)")

    def run(self, text: str) -> int:
        return sum(map(self.machine.words.__getitem__, WORD.findall(text)))

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        """(head, count, tail); a chunk without white space is all head and has no tail."""
        first = SPACE.search(chunk)
        if first is None:
            return chunk, 0, None
        end = len(chunk)
        while not chunk[end - 1].isspace() or not SPACE.match(chunk[end - 1]):
            end -= 1
        return chunk[: first.start()], self.run(chunk[first.start(): end]), chunk[end:]

    def compose(self, one: tuple[str, int, str | None], two: tuple[str, int, str | None]) -> tuple[str, int, str | None]:
        if one[2] is None:
            return one[0] + two[0], two[1], two[2]
        if two[2] is None:
            return one[0], one[1], one[2] + two[0]
        return one[0], one[1] + self.run(one[2] + two[0]) + two[1], two[2]

    def folded(self, maps: list[tuple[str, int, str | None]]) -> tuple[str, int, str | None]:
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0] if maps else ("", 0, None)

    def segment(self, text: str, chunk: int) -> int:
        text = _lowered(text) if text.isascii() or not self.odd.search(text) else self.normal(text)
        if len(text) <= chunk:
            return self.run(text)
        head, count, tail = self.folded([self.chunk_map(text[i:i + chunk]) for i in range(0, len(text), chunk)])
        return self.run(head) + count + self.run(tail or "")

    def count(self, text: str, chunk: int = CHUNK) -> int:
        parts = self.special.split(text)
        return sum(self.segment(p, chunk) for p in parts) + len(parts) - 1


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """All columns of the rows, with ``n_bytes`` and ``n_tokens`` under names that no column has."""
    n_bytes, n_tokens = fresh(docs, "n_bytes", "n_tokens")
    held: list[Counter] = []
    odd = odd_characters(path)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        if not held:
            held.append(Counter(path, odd))
        texts = [x or "" for x in batch.column(0).to_pylist()]
        return [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([held[0].count(t, chunk) for t in texts], pa.int64())]

    return append_columns(docs, ["text"], [StructField(n_bytes, LongType()), StructField(n_tokens, LongType())], make)

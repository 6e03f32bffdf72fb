"""Words of many texts at once as 64-bit hashes, by numpy over the bytes of a batch."""

from __future__ import annotations

import numpy as np

from .common import ASCII_LOWER

#: 0: white space and control, 1: letters, digits and all bytes beyond ASCII, 2: signs.
KIND = np.full(256, 2, np.uint8)
KIND[:33] = 0
KIND[127] = 0
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
with np.errstate(over="ignore"):
    POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


def tokens(texts: list[bytes], lower: bool, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, kind, text number, hash of the first ``prefix`` bytes) of every run of letters or of signs, in order.

    A run that is no longer than ``prefix`` bytes has its own hash as that of its beginning.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = ASCII_LOWER[data]
    kind = KIND[data]
    border = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    own = kind[border]
    lengths = np.diff(np.append(border, len(data)))
    place = np.arange(len(data), dtype=np.int32) - np.repeat(border.astype(np.int32), lengths)
    terms = (data.astype(np.uint64) + np.uint64(1)) * POWERS[place & 63]
    hashes = mixed(np.add.reduceat(terms, border) + lengths.astype(np.uint64))
    is_token = own > 0
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = hashes
    if prefix:
        head = mixed(np.add.reduceat(np.where(place < prefix, terms, np.uint64(0)), border) + np.uint64(1 << 40))
        begins = np.where(lengths > prefix, head, hashes)
    return hashes[is_token], own[is_token], np.searchsorted(ends, border[is_token], side="right"), begins[is_token]


def distinct(codes: np.ndarray) -> np.ndarray:
    """Sorted, each once; by sorting, which is several times faster here than hashing."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def word_hash(word: str) -> int:
    """The hash that ``tokens`` gives a single word."""
    return int(tokens([word.encode()], False)[0][0])

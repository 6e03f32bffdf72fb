"""The block coder of the token-id files: context mixing and a range coder, many blocks side by side.

A block is a run of ids that is coded with a model of its own, reset at its start. Two predictions
are learnt per block: the id that last followed the two ids before (order 2) and the one that last
followed the id before (order 1), each with a confidence. Order 0 is the shares of all ids in the
frame (``Prior``), which are stored beside the blocks. What is coded is which order is right first,
and at order 0 then the id by its share. The bounds between the three outcomes are mixed from two adaptive
tables, one under the confidences and one under the last two outcomes; the weight moves to the table
that foresaw better. All of it is integer arithmetic, so the decoder follows the same states on any
machine. Numpy advances all blocks of a call by one id a step. Any block is read with the prior alone.

An id's outcome and share are one step of the range coder, whose carries are added to the words at the end.
A prediction and its confidence are one number, and so are the two bounds, one in each half.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
_PLACES = 1024
_PRIOR_BITS = 20
_UNITS = 1 << _PRIOR_BITS
_ALL = 1 << 16  # parts of all outcomes
_RATE = 5
_HALF, _KEPT = 32, 0x7FF | 0x7FF << 32  # where the second bound begins, and what a step of both may take off
_FIELD, _IN_FIELD = 20, (1 << 20) - 1  # where outcomes' bounds stand side by side
_SPAN, _LOW = 62, 46  # bits of the widest span, and those under which 16 bits are sure but for a carry
_MASK = (1 << _LOW) - 1
_LEFT = np.array([-1, _MASK << 16])  # what stays of a low end, without and after a word
_IN_HALF = (1 << _HALF) - 1
_TILE = 64  # ids of all blocks that are turned at once
_U = np.uint64
_LANES = np.arange(1 << 16)  # more blocks in one call are coded in turns


def _bounds(first: int, second: int) -> int:
    return first | second << _HALF


#: What an outcome adds to the bounds; at least 64 parts are left for the first and the last outcome, and one for the other.
_ADDED = np.array([_bounds(2043, 2045), _bounds(2, 2045), _bounds(2, 4)])
#: The bounds at the start under the confidences (of order 2 four times, then of order 1) and under the last two outcomes.
_RIGHT2, _RIGHT1 = (0.002, 0.08, 0.5, 0.9), (0.002, 0.06, 0.3, 0.6)
_BY_SURE = np.array([_bounds(int(64000 * p), int(64000 * (p + (1 - p) * q)) + 1) for p in _RIGHT2 for q in _RIGHT1])
_BY_PAST = np.array([_bounds(int(64000 * p), int(64000 * (p + (1 - p) * q)) + 1) for p, q in zip((0.9, 0.5, 0.4, 0, 0.4, 0.2, 0.1, 0, 0.4, 0.1, 0.02, 0, 0, 0, 0, 0), (0.3, 0.3, 0.3, 0, 0.3, 0.3, 0.2, 0, 0.3, 0.1, 0.05, 0, 0, 0, 0, 0))])


class Prior:
    """Shares of the ids of a frame in parts of 2^20; every id that occurs has one at least."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        if len(ids) >= _UNITS:
            raise ValueError(f"{len(ids)} different ids in a frame, at most {_UNITS - 1} can be coded")
        self.ids, self.counts = ids.astype(np.int64), counts.astype(np.int64)
        units = 1 + self.counts * (_UNITS - len(ids)) // max(int(self.counts.sum()), 1)
        alphabet = int(ids[-1]) + 1 if len(ids) else 1
        self.start, self.units = np.zeros(alphabet, np.int64), np.zeros(alphabet, np.int64)
        self.start[self.ids], self.units[self.ids] = np.cumsum(units) - units, units

    def places(self) -> np.ndarray:
        """Start and units of each id in one number, behind a first one that takes all units, for ids that are foreseen."""
        return np.append(_UNITS, self.start << _HALF | self.units)

    @classmethod
    def of(cls, blocks: list[np.ndarray]) -> Prior:
        stream = np.concatenate(blocks) if blocks else np.zeros(0, np.int64)
        if len(stream) and stream.max() < _UNITS:  # one place an id
            counts = np.bincount(stream)
            ids = np.flatnonzero(counts)
            return cls(ids, counts[ids])
        return cls(*np.unique(stream, return_counts=True))

    def to_bytes(self) -> bytes:
        """Steps between the ids and the counts, seven bits a byte, after how many there are, packed by zlib and checked by it."""
        values = np.concatenate([[len(self.ids)], np.diff(self.ids, prepend=0), self.counts])
        parts = [values >> 7 * i & 127 | np.where(values >> 7 * (i + 1), 128, 0) for i in range(9)]
        used = np.stack([np.ones(len(values), bool)] + [values >> 7 * i > 0 for i in range(1, 9)], axis=1)
        return zlib.compress(np.stack(parts, axis=1)[used].astype(np.uint8).tobytes(), 9)

    @classmethod
    def from_bytes(cls, data: bytes) -> Prior:
        try:
            raw = np.frombuffer(zlib.decompress(data), np.uint8).astype(np.int64)
        except zlib.error as error:
            raise ValueError("damaged prior") from error
        last = raw < 128
        ends = np.flatnonzero(last)
        begins = np.append(0, ends[:-1] + 1)
        place = np.arange(len(raw)) - np.repeat(begins, ends - begins + 1)
        values = np.add.reduceat((raw & 127) << 7 * place, begins)
        n = int(values[0])
        return cls(np.cumsum(values[1: n + 1]), values[n + 1:])


class _Model:
    """The states of ``n`` blocks: what followed each place, and the bounds of the outcomes in parts of 2^16."""

    def __init__(self, n: int):
        # filled, so that it lies in large pages
        self.follow2, self.follow1 = np.full(n * _PLACES, 0, np.int32), np.full(n * _PLACES, 0, np.int32)
        self.by_sure, self.by_past = np.tile(_BY_SURE, n), np.tile(_BY_PAST, n)
        self.weight, self.past = np.full(n, 2048), np.full(n, 10)
        self.rows = _LANES[:n] * 16

    def predict(self, at2: np.ndarray, at1: np.ndarray) -> None:
        """Predictions for the first blocks, by the places of the ids before, and the bounds of the outcomes."""
        n = len(at2)
        rows = self.rows[:n]
        self.at2, self.at1, self.guess2, self.guess1 = at2, at1, self.follow2.take(at2), self.follow1.take(at1)
        self.sure2, self.sure1 = self.guess2 & 3, self.guess1 & 3
        self.row_a, self.row_b = rows + (self.sure2 << 2 | self.sure1), rows + self.past[:n]
        self.a, self.b = self.by_sure.take(self.row_a), self.by_past.take(self.row_b)
        apart = self.a - self.b
        self.behind = apart.astype(np.int32) < 0  # of the lower halves: the first bound of a is below that of b
        mixed = apart * (self.weight[:n] >> 6) + (self.b << 6)
        self.first, self.second = mixed >> 6 & 0xFFFF, mixed >> 6 + _HALF

    def parts_of(self, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts below the outcomes, and their own parts."""
        bounds, field = self.second << _FIELD | self.first, outcome * _FIELD
        below = (bounds << _FIELD) >> field & _IN_FIELD
        return below, ((bounds | _ALL << 2 * _FIELD) >> field & _IN_FIELD) - below

    def learn(self, stored: np.ndarray, right2: np.ndarray, right1: np.ndarray, outcome: np.ndarray) -> None:
        """Go on by one id, of which ``stored`` is one more."""
        n, stored = len(stored), stored << 2
        self.follow2[self.at2] = stored + np.minimum(self.sure2 * right2 + 1, 3)
        self.follow1[self.at1] = stored + np.minimum(self.sure1 * right1 + 1, 3)
        weight, a, b = self.weight[:n], self.a, self.b
        weight += (self.behind ^ right2) * 4095 - weight >> _RATE
        added = _ADDED.take(outcome)
        self.by_sure[self.row_a] = a - (a >> _RATE & _KEPT) + added
        self.by_past[self.row_b] = b - (b >> _RATE & _KEPT) + added
        self.past[:n] = (self.past[:n] & 3) << 2 | outcome


def _places(last1: np.ndarray, last2: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the model keeps what followed the last two ids, and the last; ``lane`` is the block's first place."""
    one = np.multiply(last1, 20021, dtype=np.int64)
    return lane + (one + np.multiply(last2, 15013, dtype=np.int64) >> 3 & _PLACES - 1), lane + (one >> 5 & _PLACES - 1)


def _lengths(blocks: list[int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array(blocks, np.int64)
    order = np.argsort(-lengths, kind="stable")
    return order, lengths[order]


def encode(blocks: list[np.ndarray], prior: Prior) -> list[bytes]:
    """Each block as bytes; the prior knows all their ids."""
    if not blocks:
        return []
    if len(blocks) > len(_LANES):
        return encode(blocks[: len(_LANES)], prior) + encode(blocks[len(_LANES):], prior)
    order, lengths = _lengths([len(b) for b in blocks])
    n, longest = len(blocks), int(lengths[0])
    held = np.zeros((n, longest), np.int32)
    for lane, which in enumerate(order):
        held[lane, : lengths[lane]] = blocks[which]
    ids = np.zeros((longest + 2, n), np.int32)  # one more than the id, after two places of none
    for t in range(0, longest, _TILE):
        np.add(held[:, t: t + _TILE].T, 1, out=ids[t + 2: t + 2 + _TILE])
    del held
    model, lane, low, span, places = _Model(n), _LANES[:n] * _PLACES, np.zeros(n, np.int64), np.full(n, (1 << _SPAN) - 1), prior.places()
    room = longest * (16 + _PRIOR_BITS) // 16 + 8  # words of a lane at most
    words, at = np.zeros(n * room, np.uint32), _LANES[:n] * room
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")  # lanes longer than t
    for t in range(longest):
        m = int(alive[t])
        now = ids[t + 2, :m].astype(np.int64)
        model.predict(*_places(ids[t + 1, :m], ids[t, :m], lane[:m]))
        right2, right1 = model.guess2 >> 2 == now, model.guess1 >> 2 == now
        by_share = ~(right2 | right1)
        outcome = np.add(~right2, by_share, dtype=np.int64)
        below, share = model.parts_of(outcome)
        lo, sp, where = low[:m], span[:m], at[:m]
        part = sp >> 16 + _PRIOR_BITS
        part_of = places.take(now * by_share)
        unit = part * share
        lo += (part * below << _PRIOR_BITS) + unit * (part_of >> _HALF)
        np.multiply(unit, part_of & _IN_HALF, out=sp)
        full = sp <= _MASK
        words[where] = lo >> _LOW  # written over by the next one unless it is full
        where += full
        shift = full * 16
        lo <<= shift
        lo &= _LEFT.take(full)
        sp <<= shift
        go = np.flatnonzero(sp <= _MASK)
        while len(go):
            one, two, place = lo[go], sp[go] << 16, where[go]
            words[place], where[go] = one >> _LOW, place + 1
            lo[go], sp[go] = (one & _MASK) << 16, two
            go = go[two <= _MASK]
        model.learn(now, right2, right1, outcome)
    for _ in range(4):
        words[at] = low >> _LOW
        at += 1
        low = (low & _MASK) << 16
    sizes = at - _LANES[:n] * room
    ends = np.cumsum(sizes)
    words = np.concatenate([words[a - k: a] for a, k in zip(at.tolist(), sizes.tolist())])
    while len(over := np.flatnonzero(words > 0xFFFF)):  # a block's first word has no carry
        words[over] &= 0xFFFF
        words[over - 1] += 1
    data, out = words.astype("<u2"), [b""] * n
    for lane, which in enumerate(order):
        out[which] = data[ends[lane - 1] if lane else 0: ends[lane]].tobytes()
    return out


def decode(coded: list[bytes], counts: list[int], prior: Prior) -> list[np.ndarray]:
    """The ids of each block, ``counts`` of them, by the prior they were coded with."""
    if not coded:
        return []
    if len(coded) > len(_LANES):
        return decode(coded[: len(_LANES)], counts[: len(_LANES)], prior) + decode(coded[len(_LANES):], counts[len(_LANES):], prior)
    order, lengths = _lengths(counts)
    n, longest = len(coded), int(lengths[0])
    words = np.frombuffer(b"".join(coded[i] for i in order) + bytes(32), "<u2").astype(np.uint64)
    sizes = np.array([len(coded[i]) // 2 for i in order], np.int64)
    at = np.cumsum(sizes) - sizes
    # a span of 62 bits begins with three words and 14 bits, so the next 16 bits always lie in two words
    w0, w1, w2, w3 = (words[np.minimum(at + i, len(words) - 1)] for i in range(4))
    code = w0 << _U(46) | w1 << _U(30) | w2 << _U(14) | w3 >> _U(2)
    nexts = (words[:-1] << _U(14) | words[1:] >> _U(2)) & _U(0xFFFF)
    at += 3
    code, nexts = code.view(np.int64), nexts.view(np.int64)
    symbols, places = np.repeat(prior.ids.astype(np.min_scalar_type(len(prior.units) + 1)) + 1, prior.units[prior.ids]), prior.places()
    model, lane, span, ids = _Model(n), _LANES[:n] * _PLACES, np.full(n, (1 << _SPAN) - 1), np.zeros((longest + 2, n), np.int32)
    alive = np.searchsorted(-lengths, -np.arange(longest), side="left")
    for t in range(longest):
        m = int(alive[t])
        model.predict(*_places(ids[t + 1, :m], ids[t, :m], lane[:m]))
        sp, co, where = span[:m], code[:m], at[:m]
        part = sp >> 16 + _PRIOR_BITS
        wide = part << _PRIOR_BITS
        wrong2, by_share = co >= wide * model.first, co >= wide * model.second
        outcome = np.add(wrong2, by_share, dtype=np.int64)
        below, share = model.parts_of(outcome)
        co -= wide * below
        unit = part * share
        foreseen = np.where(wrong2, model.guess1, model.guess2) >> 2
        found = symbols.take(co // unit, mode="clip")
        now = np.maximum(np.where(by_share, found, foreseen), 1).astype(np.int64)  # a damaged block may lead anywhere
        ids[t + 2, :m] = now
        right2, right1 = ~wrong2, (model.guess1 >> 2 == now) & ~by_share
        part_of = places.take(now * by_share)
        co -= unit * (part_of >> _HALF)
        np.multiply(unit, part_of & _IN_HALF, out=sp)
        full = sp <= _MASK
        shift = full * 16
        co <<= shift
        co |= nexts.take(where, mode="clip") * full
        sp <<= shift
        where += full
        go = np.flatnonzero(sp <= _MASK)
        while len(go):
            two, place = sp[go] << 16, where[go]
            co[go] = co[go] << 16 | nexts.take(place, mode="clip")
            sp[go], where[go] = two, place + 1
            go = go[two <= _MASK]
        model.learn(now, right2, right1, outcome)
    held = np.zeros((n, longest), "<u4")
    for t in range(0, longest, _TILE):
        held[:, t: t + _TILE] = ids[t + 2: t + 2 + _TILE].T - 1
    out: list = [None] * n
    for lane, which in enumerate(order):
        out[which] = held[lane, : lengths[lane]]
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())

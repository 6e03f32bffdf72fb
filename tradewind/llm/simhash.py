"""SimHash near-duplicates: fingerprints, a hierarchical index in Gray order, and groups of linked documents.

Method: two fingerprints that differ in d bits at most agree on at least one of d + 1 parts of the bits.
Fingerprints are therefore filed under upper nodes, each a mask and the pattern its members share
below that mask. Members stand in the order of their Gray rank, in which neighbours differ little;
over them the task builds further levels, each node with the bits that all its members share, and
compares whole nodes: the differing bits that two nodes share already are a lower bound, and a pair
of nodes beyond the allowed number is dropped with everything below it. Upper nodes with too many
members are filed again under larger masks; with 14 bits left a node has 2^14 members at most, so
at a distance of 2 what a task holds is bounded whatever the data. (Larger distances need more masks
and stop refining earlier; a node is then 8 bytes a distinct fingerprint.)

Defined results: a null or wordless text has fingerprint zero and links like any other; repeated
rows and ties share a fingerprint, hence a group; an empty table gives no rows; only ``doc_id`` and
``text`` are read, so other columns may have any name; null ids belong to the group of their text
and never name it unless the group has no other id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from ..session import staged
from .common import append_columns, fresh, pieces, spread_join, stored, text_bytes

WORDS = 3
DISTANCE = 2
SEED = 42
#: An upper node with more members is filed again under larger masks.
NODE_MEMBERS = 4096
FREE_BITS = 14
#: More masks are not refined further; at the registered distance of 2 the free bits run out first.
MOST_MASKS = 1024
FANOUT = 8
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ALL = (1 << 64) - 1


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> list[int]:
    """XXH64 of every run of ``words`` words, joined by spaces; of the whole sequence if it is shorter."""
    found = _WORD.findall(text.translate(_LOWER))
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = list(accumulate(len(w) + 1 for w in found))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], seed) for a, b in zip([0, *ends], [e - 1 for e in ends[words - 1:]])]


def fingerprints_of(texts: list[bytes], words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Fingerprints as signed 64-bit integers; a bit is set if more than half the hashes have it."""
    out = np.zeros(len(texts), np.uint64)
    weights = (np.uint64(1) << np.arange(64, dtype=np.uint64))

    def settle(rows: list[int], counts: list[int], hashes: list[int]) -> None:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[rows] = ((2 * ones > np.array(counts)[:, None]) * weights).sum(axis=1, dtype=np.uint64)

    rows, counts, hashes = [], [], []
    for i, text in enumerate(texts):
        own = shingle_hashes(text, words, seed)
        if own:
            rows.append(i)
            counts.append(len(own))
            hashes += own
        if len(hashes) > 200_000:
            settle(rows, counts, hashes)
            rows, counts, hashes = [], [], []
    if rows:
        settle(rows, counts, hashes)
    return out.view(np.int64)


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = text_bytes(batch.column(0))
        parts = [fingerprints_of(texts[a:b]) for a, b in pieces(texts)]
        return [pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))]

    return append_columns(docs, ["text"], [StructField(name, LongType())], make)


def gray_rank(value: Column) -> Column:
    """Place of a bit pattern in the reflected Gray code."""
    for by in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, by))
    return value


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def larger_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """The mask with one of ``distance + 1`` equal parts of its free bits added: fingerprints that
    agree below the mask and differ in ``distance`` bits at most agree below one of these."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [round(i * len(free) / (distance + 1)) for i in range(distance + 2)]
    return [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cut, cut[1:])]


def upper_nodes(prints: DataFrame, members: int = NODE_MEMBERS, distance: int = DISTANCE) -> DataFrame:
    """``prints(fp)``, distinct, filed under nodes (mask, pattern); any two within ``distance`` share one."""
    masks, done = [0], None
    rest = prints.select("fp", F.lit(0).cast("long").alias("mask"))
    while True:
        refined = {m: larger_masks(m, distance) for m in masks}
        choices = F.create_map(*[x for m, new in refined.items() for x in (F.lit(_signed(m)).cast("long"), F.array(*[F.lit(_signed(n)).cast("long") for n in new]))])
        filed = rest.select("fp", F.explode(choices[F.col("mask")]).alias("mask")).withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        masks = sorted({n for new in refined.values() for n in new})
        if min(m.bit_count() for m in masks) >= 64 - FREE_BITS or len(masks) * (distance + 1) > MOST_MASKS:
            return filed if done is None else done.unionByName(filed)
        filed = staged(filed, "nodes")
        large = staged(filed.groupBy("mask", "pattern").count().filter(F.col("count") > members).select("mask", "pattern", F.lit(True).alias("large")), "large-nodes")
        if large.isEmpty():
            return filed if done is None else done.unionByName(filed)
        told = filed.join(large, ["mask", "pattern"], "left")
        small = told.filter(F.col("large").isNull()).select("fp", "mask", "pattern")
        done = small if done is None else done.unionByName(small)
        rest = told.filter("large").select("fp", "mask")


def _levels(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask) of the members, then of each level of groups of neighbours above them."""
    levels = [(members, np.full(len(members), _ALL, np.uint64))]
    while len(levels[-1][0]) > FANOUT:
        pattern, mask = levels[-1]
        starts = np.arange(0, len(pattern), FANOUT)
        firsts = np.repeat(pattern[starts], np.diff(np.append(starts, len(pattern))))
        shared = np.bitwise_and.reduceat(mask & ~(pattern ^ firsts), starts)
        levels.append((pattern[starts] & shared, shared))
    return levels


def _ranges(label: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Smallest and largest label below each node of each level."""
    out = [(label, label)]
    for _ in range(depth - 1):
        low, high = out[-1]
        starts = np.arange(0, len(low), FANOUT)
        out.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
    return out


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the pairs' groups are joined; a group's label is its smallest member."""
    while True:
        one, two = label[a], label[b]
        if (one == two).all():
            return label
        low = np.minimum(one, two)
        np.minimum.at(label, one, low)
        np.minimum.at(label, two, low)
        while (label != label[label]).any():
            label = label[label]


def node_links(members: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """A link from each member of a linked group, but the smallest, to its group's smallest.

    Pairs of nodes are descended into from the top; a pair goes when it is too far apart, and also
    when all below it is in one group already, so a tight cluster costs no look at all its pairs.
    """
    levels, label = _levels(members), np.arange(len(members))
    ranges = _ranges(label, len(levels))
    stack = [(len(levels) - 1, *np.triu_indices(len(levels[-1][0])))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > (1 << 12 if level else 1 << 17):
            stack += [(level, a[len(a) // 2:], b[len(a) // 2:]), (level, a[: len(a) // 2], b[: len(a) // 2])]
            continue
        low, high = ranges[level]
        apart = (low[a] != high[b]) | (low[b] != high[a])
        a, b = a[apart], b[apart]
        pattern, mask = levels[level]
        near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level == 0:
            label = _united(label, a, b)
            ranges = _ranges(label, len(levels))
        else:
            below, kid = len(levels[level - 1][0]), np.arange(FANOUT)
            left = (a[:, None, None] * FANOUT + kid[:, None] + 0 * kid).reshape(-1)
            right = (b[:, None, None] * FANOUT + kid + 0 * kid[:, None]).reshape(-1)
            keep = (left <= right) & (left < below) & (right < below)
            stack.append((level - 1, left[keep], right[keep]))
    moved = np.flatnonzero(label != np.arange(len(members)))
    return members[label[moved]], members[moved]


def links(prints: DataFrame, members: int = NODE_MEMBERS, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) that join all of ``prints(fp)`` within ``distance``, fewer than members in any node."""
    filed = upper_nodes(prints, members, distance)
    sorted_nodes = filed.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
            ends = np.append(starts[1:], len(rows))
            found = [node_links(rows[s:e, 2].view(np.uint64), distance) for s, e in zip(starts, ends) if e - s > 1]
            one = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in one], names=["a", "b"])

        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("mask", "pattern", "fp")], axis=1)])
            if not len(held):
                continue
            other = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))
            whole = other[-1] + 1 if len(other) else 0  # the last node may go on in the next batch
            if whole:
                yield linked(np.ascontiguousarray(held[:whole]))
                held = held[whole:]
        if len(held):
            yield linked(np.ascontiguousarray(held))

    return sorted_nodes.select("mask", "pattern", "fp").mapInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges(a, b)``, root being the smallest node that can be reached.

    Alternating large and small stars: every round hangs neighbours under the smallest neighbour, in
    a logarithmic number of rounds in practice. Rounds are written tables; a hub's edges are dealt
    into slots, and only counts and a checksum reach the driver.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = spread_join(both, lowest, "a", ["b"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, lowest, "a", ["b"]).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = staged(small.filter("a != b").distinct(), "edges")
        was, now = now, state(edges)
        if was == now:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def groups(prints: DataFrame, order: Column, members: int = NODE_MEMBERS, distance: int = DISTANCE) -> DataFrame:
    """One row (fp, first) for each fingerprint of ``prints``: the smallest ``order`` of its linked group."""
    lowest = staged(prints.groupBy("fp").agg(F.min(order).alias("own")), "prints")
    roots = staged(components(links(lowest.select("fp"), members, distance)).withColumnRenamed("node", "fp"), "roots")
    met = lowest.join(roots, "fp", "left")
    in_group = met.filter(F.col("root").isNotNull())
    first = spread_join(in_group, in_group.groupBy("root").agg(F.min("own").alias("first")), "root", ["fp"])
    alone = met.filter(F.col("root").isNull())
    return alone.select("fp", F.col("own").alias("first")).unionByName(first.select("fp", "first"))


def near_duplicates(docs: DataFrame, members: int = NODE_MEMBERS, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    prints = staged(with_fingerprint(docs.select("doc_id", "text"), "fp").select("doc_id", "fp"), "fingerprints")
    named = groups(prints, F.col("doc_id"), members, distance).withColumnRenamed("first", "component_id")
    return spread_join(prints, named, "fp", ["doc_id"]).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, members: int = NODE_MEMBERS, distance: int = DISTANCE) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest id stays.

    Rows with one id, repeated rows included, are told apart by their place in a written copy.
    """
    fp, row = fresh(docs, "fp", "row")
    marked = stored(with_fingerprint(docs, fp).withColumn(row, F.monotonically_increasing_id()), "fingerprinted")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col(row).alias("row"))
    firsts = groups(marked.select(F.col(fp).alias("fp"), order.alias("own")), F.col("own"), members, distance)
    kept = firsts.select(F.col("first.row").alias(row)).distinct()
    return marked.join(kept, row, "left_semi").select(*docs.columns)

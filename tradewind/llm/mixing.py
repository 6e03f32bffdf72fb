"""Mixing sources to target weights by blocks of words.

Method: the words of a source, its documents in a fixed order, are packed into blocks of a fixed
length. Each output shard draws how many of its slots every source gets: multinomial draws given
that the sources' totals come out at their targets. A source's slots, numbered through all shards,
are mapped to its blocks by a keyed pseudorandom permutation of the block numbers, a new one for
each time round, so that no block is taken a second time before all were taken once. Slots meet
blocks by index.

Defined results: a null source is a source of its own, last in order; a null, empty or wordless text
has size 0 and nothing of it is taken; repeated rows are documents of their own; rows with equal ids
are ordered by size and text; an empty table gives no rows; of other columns, whatever their names,
none is read. The plan of a mix is drawn from the seed and the totals alone, so reruns agree. Only
one row a source reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import staged
from .common import fresh, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
BLOCK_WORDS = 64
SHARDS = 64
SEED = 42
#: A source's documents are laid out bucket by bucket; more buckets, shorter runs in one task.
BUCKETS = 1024
SLOTS_A_ROW = 4096
SLOTS_A_TASK = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_TIMES) -> list[float]:
    """Words wanted of each source: shares by weight, what is above ``most`` times a size shared anew."""
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    held: dict[int, float] = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in held]
        left = share * sum(sizes) - sum(held.values())
        total = sum(weight[i] for i in free)
        wanted = {i: left * weight[i] / total for i in free}
        above = {i: float(most * sizes[i]) for i in free if wanted[i] > most * sizes[i]}
        if not above or len(above) == len(free):
            held |= above
            return [held[i] if i in held else wanted[i] for i in range(len(sizes))]
        held |= above


def draws(quotas: list[int], shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Slots (shard, source): each shard's draw from what the sources have left, totals exactly ``quotas``."""
    left = np.array(quotas, np.int64)
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), np.int64)
    for shard in range(shards):
        slots = int(left.sum()) // (shards - shard)
        if shard == shards - 1:
            out[shard] = left
        elif slots:
            taken = np.minimum(rng.multinomial(slots, left / left.sum()), left)
            for i in np.argsort(taken - left, kind="stable"):  # what a source could not give, those with most left give
                more = min(slots - int(taken.sum()), int(left[i] - taken[i]))
                taken[i] += more
            out[shard] = taken
        left = left - out[shard]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..size-1: a Feistel network over the next even number of bits, walked
    on from every value that lands outside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)

    def mixed(x: np.ndarray, turn: int) -> np.ndarray:
        x = x + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xBF58476D1CE4E5B9 + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & low

    value, outside = index.astype(np.uint64), np.ones(len(index), bool)
    while outside.any():
        left, right = value[outside] >> np.uint64(half), value[outside] & low
        for turn in range(4):
            left, right = right, left ^ mixed(right, turn)
        value[outside] = left << np.uint64(half) | right
        outside = value >= size
    return value.astype(np.int64)


def _laid_out(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with key and bucket, one row (key, bucket) with the words before it in its source)."""
    marked = rows.withColumn("key", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source"))))
    marked = staged(marked.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")), "sized")
    totals = staged(marked.groupBy("key", "bucket").agg(F.sum("size").alias("words")), "bucket-words")
    before = F.sum("words").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    return marked, totals.select("key", "bucket", "words", F.coalesce(before, F.lit(0)).alias("before"))


def _plan(totals: DataFrame, weights, share, most, block, shards, seed) -> tuple[DataFrame, DataFrame, int]:
    """Per source its size and target; the slots of all shards as ranges (key, blocks, first, count); all slots."""
    spark = totals.sparkSession
    sizes = sorted(((r["key"], int(r["words"])) for r in totals.groupBy("key").agg(F.sum("words").alias("words")).collect()), key=lambda x: (x[0][0] == "n", x[0]))
    wanted = targets([n for _, n in sizes], weights, share, most) if sizes else []
    blocks = [-(-n // block) for _, n in sizes]
    quotas = [min(round(t / n * b), int(most * b)) if n else 0 for (_, n), t, b in zip(sizes, wanted, blocks)]
    shares = draws(quotas, shards, seed) if sizes else np.zeros((0, 0), np.int64)
    firsts = np.cumsum(shares, axis=0) - shares
    ranges = [(sizes[j][0], j, blocks[j], i, int(firsts[i, j]), int(shares[i, j])) for i in range(len(shares)) for j in range(len(sizes)) if shares[i, j]]
    per_source = spark.createDataFrame([(k, n, float(t)) for (k, n), t in zip(sizes, wanted)], "key string, source_size long, target double")
    return per_source, spark.createDataFrame(ranges, "key string, rank int, blocks long, shard int, first long, slots long"), sum(quotas)


def _slots(ranges: DataFrame, seed: int, tasks: int) -> DataFrame:
    """(key, shard, slot, block): every slot with the block it is mapped to."""
    rows = ranges.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("slots") - 1) / SLOTS_A_ROW).cast("long"))))
    rows = rows.repartition(tasks, "key", "shard", "row")

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                begin = r.row * SLOTS_A_ROW
                slot = np.arange(r.first + begin, r.first + min(r.slots, begin + SLOTS_A_ROW))
                block, turns = np.empty_like(slot), slot // r.blocks
                for turn in np.unique(turns):
                    at = turns == turn
                    block[at] = permuted(slot[at] % r.blocks, r.blocks, seed * 1_000_003 + r.rank * 1009 + int(turn))
                yield pd.DataFrame({"key": r.key, "shard": r.shard, "slot": slot, "block": block})

    return rows.mapInPandas(mapped, "key string, shard int, slot long, block long")


def taken_pieces(rows: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_TIMES, block=BLOCK_WORDS, shards=SHARDS, seed=SEED) -> DataFrame:
    """``rows(doc_id, source, size, tie, ...)`` cut at the borders of blocks, with the times each piece is taken.

    Adds source_size, target, start (words of the source before the document), block, piece (its
    words there) and times; a row of size 0 has one line with neither block nor piece.
    """
    marked, totals = _laid_out(rows)
    per_source, ranges, slots = _plan(totals, weights, share, most, block, shards, seed)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, slots // SLOTS_A_TASK)
    # the planner cannot foresee how many slots the few ranges become, so it must not broadcast them
    times = _slots(ranges, seed, tasks).groupBy("key", "block").agg(F.count(F.lit(1)).alias("times")).hint("merge")
    order = Window.partitionBy("key", "bucket").orderBy("doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    bucketed = totals.join(per_source, "key").select("key", "bucket", "before", "source_size", "target")
    placed = marked.withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0))).join(bucketed, ["key", "bucket"])
    placed = placed.withColumn("start", F.col("before") + F.col("inside"))
    end = F.col("start") + F.col("size")
    number = F.when(F.col("size") > 0, F.sequence((F.col("start") / block).cast("long"), ((end - 1) / block).cast("long")))
    pieces = placed.withColumn("block", F.explode_outer(number)).withColumn("piece", F.least(end, (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block))
    kept = [*rows.columns, "source_size", "target", "start", "block", "piece"]
    return pieces.join(times, ["key", "block"], "left").select(*kept, F.coalesce("times", F.lit(0)).alias("times"), "key")


def _sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("tie"))


def mixture(docs: DataFrame, **plan) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row."""
    pieces = taken_pieces(_sizes(docs), **plan)
    keys = ["doc_id", "size", "source_size", "target", "key", "start", "tie"]
    whole = pieces.filter("size > 0").groupBy(*keys).agg(F.sum(F.col("piece") * F.col("times")).alias("taken"))
    none = pieces.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    names = ["doc_id", "size", "source_size", "target", "taken"]
    return whole.select(*names).unionByName(none.select(*names))


def mixed(docs: DataFrame, block: int = BLOCK_WORDS, **plan) -> DataFrame:
    """The documents of the mix: one row for each time round that took any of a document's blocks.

    Where all its blocks were taken the row is the document as it was; else its text is the runs of
    words that were taken, parted by line breaks. A column ``n_chars`` is brought up to date.
    """
    (row,) = fresh(docs, "row")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "to-mix")
    sizes = whole.select("doc_id", "source", F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.col(row).alias("tie"))
    pieces = taken_pieces(sizes, block=block, **plan).filter("times > 0")
    runs = pieces.groupBy("tie").agg(F.sort_array(F.collect_list(F.struct(F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("first"), F.col("piece"), F.col("times")))).alias("runs"))
    runs_name, time_name = fresh(whole, "runs", "time")
    met = whole.join(runs.select(F.col("tie").alias(row), F.col("runs").alias(runs_name)), row)
    copies = met.withColumn(time_name, F.explode(F.sequence(F.lit(1).cast("long"), F.array_max(F.transform(runs_name, lambda r: r["times"])))))
    word = re.compile(r"[^\x20\x09-\x0D]+")

    @F.pandas_udf(StringType())
    def cut(texts: pd.Series, runs: pd.Series, time: pd.Series) -> pd.Series:
        def one(text: str, runs: list[dict], time: int) -> str:
            spans = [m.span() for m in word.finditer(text)]
            kept: list[list[int]] = []
            for r in runs:
                if r["times"] >= time:
                    if kept and kept[-1][1] == r["first"]:
                        kept[-1][1] += r["piece"]
                    else:
                        kept.append([r["first"], r["first"] + r["piece"]])
            if kept == [[0, len(spans)]]:
                return text
            return "\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in kept)

        return pd.Series([one(*x) for x in zip(texts, runs, time)], dtype=object)

    out = copies.withColumn("text", cut("text", runs_name, time_name))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)

"""Changes to few rows of a large table, found on narrow columns and put into the rows by their key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: A patch of so many rows and bytes at most is sent to every task.
SMALL_ROWS, SMALL_BYTES = 50_000, 8 << 20
#: Bits kept per patched row, and the most bits of all (64 MB).
BITS_A_ROW, MOST_BITS = 16, 1 << 29
_WORD, _WORDS = 64, 512


def _place(key: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(bits))


def key_bits(patch: DataFrame, key: list[str], bits: int) -> DataFrame:
    """``_bucket, _words``: a bit map of the keys' hashes, 512 words of 64 bits a row. Its size hangs on ``bits`` alone."""
    placed = patch.select(_place([F.col(k) for k in key], bits).alias("_at"))
    marks = placed.select(F.expr(f"_at div {_WORD}").alias("_word"), F.expr(f"shiftleft(1L, cast(_at % {_WORD} as int))").alias("_bit"))
    # every word of a row is there, so that the words need only be put in order
    marked = marks.select(F.expr(f"_word div {_WORDS}").alias("_bucket")).distinct()
    blank = marked.select(F.explode(F.expr(f"sequence(_bucket * {_WORDS}, _bucket * {_WORDS} + {_WORDS - 1})")).alias("_word"), F.lit(0).cast("long").alias("_bit"))
    words = marks.union(blank).groupBy("_word").agg(F.bit_or("_bit").alias("_set"))
    packed = words.groupBy(F.expr(f"_word div {_WORDS}").alias("_bucket")).agg(F.sort_array(F.collect_list(F.struct("_word", "_set"))).alias("_held"))
    return packed.select("_bucket", F.col("_held")["_set"].alias("_words"))


def _marked(rows: DataFrame, key: list[str], held: DataFrame, held_key: list[str], count: int, most_bits: int) -> tuple[DataFrame, Column]:
    """The rows beside their part of a broadcast bit map of the held keys, and whether their bit is set."""
    bits = _WORD * _WORDS
    while bits < min(BITS_A_ROW * count, most_bits):
        bits *= 2
    marked = staged(key_bits(held, held_key, bits), "patch-bits")
    placed = rows.withColumn("_at", _place([F.col(k) for k in key], bits))
    met = placed.join(F.broadcast(marked), F.expr(f"_at div {_WORD * _WORDS}") == F.col("_bucket"), "left")
    return met, F.expr(f"coalesce(shiftright(_words[cast(_at div {_WORD} % {_WORDS} as int)], cast(_at % {_WORD} as int)) & 1L, 0L) = 1L")


def possible(rows: DataFrame, key: list[str], held: DataFrame, held_key: list[str], most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose key is among the held ones (staged), and few others. Nothing but the bit map is exchanged."""
    met, is_set = _marked(rows, key, held, held_key, held.count(), most_bits)
    return met.filter(is_set).select(*rows.columns)


def possibly_repeated(rows: DataFrame, key: list[str]) -> DataFrame:
    """All rows of keys that stand in more than one row, and few others: a first pass exchanges only the keys' hashes."""
    hashes = rows.select(F.xxhash64(*key).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    again = staged(hashes.filter("_rows > 1").select("_hash"), "repeated")
    hashed = rows.withColumn("_hash", F.xxhash64(*key))
    return possible(hashed, ["_hash"], again, ["_hash"]).drop("_hash")


@dataclass(frozen=True)
class Patch:
    """A staged patch: a row for few of the keys of a table, with the columns to put into its rows."""

    packed: DataFrame
    key: list[str]
    columns: list[str]
    rows: int
    bytes: int

    def put(self, rows: DataFrame, small_rows: int = SMALL_ROWS, small_bytes: int = SMALL_BYTES, most_bits: int = MOST_BITS) -> DataFrame:
        """Left join of the patch to rows that its key tells apart. NULL keys match NULL keys.

        A small patch is broadcast. For a larger one a bit map of its keys is broadcast instead: rows
        whose bit is not set cannot be in the patch and stay where they are; only the others, patched
        rows and one in sixteen besides, are exchanged. Once a patch outgrows ``most_bits`` more rows
        are exchanged than need be, down to a plain join; the result is the same.
        """
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_patch_{k}")) for k in self.key])
        kept = [*rows.columns, *[F.col("_patch")[c].alias(c) for c in self.columns]]
        if self.rows <= small_rows and self.bytes <= small_bytes:
            return rows.join(F.broadcast(self.packed), same, "left").select(*kept)
        met, is_set = _marked(rows, self.key, self.packed, [f"_patch_{k}" for k in self.key], self.rows, most_bits)
        types = self.packed.schema["_patch"].dataType
        untouched = met.filter(~is_set).select(*rows.columns, *[F.lit(None).cast(types[c].dataType).alias(c) for c in self.columns])
        return untouched.union(met.filter(is_set).select(*rows.columns).join(self.packed, same, "left").select(*kept))


def patch(changes: DataFrame, key: list[str], columns: list[str]) -> Patch:
    """The changes, computed once and measured."""
    packed = staged(changes.select(*[F.col(k).alias(f"_patch_{k}") for k in key], F.struct(*columns).alias("_patch")), "patch")
    size = F.coalesce(F.sum(F.length(F.to_json(F.struct(*[f"_patch_{k}" for k in key], "_patch")))), F.lit(0))
    rows, held = packed.agg(F.count(F.lit(1)), size).first()
    return Patch(packed, key, columns, rows, held)

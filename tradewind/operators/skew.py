"""Lookups by keys of which a few may hold a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .patching import patch, possible

#: Parts into which the rows of every key are dealt.
SLOTS = 64
#: A lookup of so few rows is broadcast; a larger one meets the rows slot by slot. The result is the same.
SMALL_ROWS = 50_000
#: And so many bytes of keys.
SMALL_BYTES = 8 << 20


def row_counts(df: DataFrame, keys: list[str], name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def attach(
    rows: DataFrame, lookup: DataFrame, keys: list[str], values: list[str], spread_by: list[str] | None = None,
    slots: int = SLOTS, small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Left join of ``values`` from a lookup with one row per key, safe against hot keys. NULL keys match NULL keys.

    The lookup is staged first, so it is computed once and its size is known before the join is
    planned; the rows are not counted. A small lookup is broadcast. For a larger one the rows of
    every key are dealt into slots by ``spread_by``: each (key, slot) that occurs fetches the lookup's
    row once, and rows meet these pairs on key and slot. So no task gets more than one slot of a
    key, whether the lookup knows the key or not, and NULL is a key like any other.
    """
    packed = _packed(lookup, keys, values)
    return _met(rows, packed, keys, values, spread_by, slots, _is_small(packed, small_rows))


def attach_few(
    rows: DataFrame, lookup: DataFrame, keys: list[str], values: list[str], order: list[str], wanted: Column, beside: list[str] = (),
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Like ``attach``, for values of which few rows are ``wanted``; in the others they are NULL.

    A small lookup is broadcast to the rows. For a larger one only ``order``, which tells the rows
    apart, the keys and the columns ``beside`` that ``wanted`` looks at are exchanged, and these only of rows whose keys
    a bit map of the lookup's keys holds; what is wanted is then put into the whole rows as a patch.
    """
    packed = _packed(lookup, keys, values)
    if _is_small(packed, small_rows):
        met = _met(rows, packed, keys, values, None, SLOTS, True)
        return met.select(*rows.columns, *[F.when(wanted, F.col(v)).alias(v) for v in values])
    narrow = possible(rows.select(*dict.fromkeys([*order, *keys, *beside])), keys, packed, [f"_key_{k}" for k in keys])
    met = _met(narrow, packed, keys, values, order, SLOTS, False).filter(wanted)
    return patch(met, order, values).put(rows)


def _packed(lookup: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return staged(lookup.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.struct(*values).alias("_found")), "lookup")


def _is_small(packed: DataFrame, small_rows: int) -> bool:
    """Few rows, and few bytes of keys."""
    if small_rows < 1:
        return False
    length = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in packed.columns if k != "_found"])
    held = packed.limit(small_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(length), F.lit(0))).first()
    return held[0] <= small_rows and held[1] <= SMALL_BYTES


def _met(rows: DataFrame, packed: DataFrame, keys: list[str], values: list[str], spread_by: list[str] | None, slots: int, small: bool) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    kept = [*rows.columns, *[F.col("_found")[v].alias(v) for v in values]]
    if small:
        return rows.join(F.broadcast(packed), same, "left").select(*kept)
    dealt = rows.withColumn("_slot", F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.lit(slots)))
    pairs = dealt.select(*keys, F.col("_slot").alias("_pair_slot")).distinct().join(packed, same)
    carried = pairs.select("_pair_slot", *[F.col(f"_key_{k}") for k in keys], "_found")
    return dealt.join(carried, same & (F.col("_slot") == F.col("_pair_slot")), "left").select(*kept)

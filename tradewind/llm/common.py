"""What several operators share: columns from Arrow batches, joins that hot keys do not hurt, text as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path

SLOTS = 64
#: Rows of one batch are worked on in pieces of about this many bytes of text.
PIECE_BYTES = 3 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """Like ``staged``, packed more tightly: for tables that hold whole texts."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the table has, whatever its columns are called."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def append_columns(df: DataFrame, reads: list[str], fields: list[StructField], make: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """All columns of the table and the new ones that ``make`` derives from the columns it reads, batch by batch."""
    types = [pa.string() if f.dataType.typeName() == "string" else None for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = make(batch.select(reads))
            made = [a if t is None else a.cast(t) for a, t in zip(made, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.name for f in fields]])

    return df.mapInArrow(run, StructType([*df.schema.fields, *fields]))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text, a null as an empty one."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a text is never cut."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, spread_by: list[str | Column], slots: int = SLOTS) -> DataFrame:
    """Left join of a lookup with one row a key to rows of which one key may hold any share.

    The rows of a key are dealt into slots. Each (key, slot) pair that occurs, of which a key has
    ``slots`` at most, fetches the lookup's row once; then rows and pairs meet on key and slot. No
    task gets more than one slot of a key, nothing is broadcast and no key is treated specially.
    A null key finds nothing.
    """
    (slot,) = fresh(rows.join(lookup.limit(0), key), "slot")
    dealt = rows.withColumn(slot, F.pmod(F.xxhash64(*spread_by), F.lit(slots)).cast("int"))
    pairs = dealt.select(key, slot).filter(F.col(key).isNotNull()).distinct()
    return dealt.join(pairs.join(lookup, key), [key, slot], "left").drop(slot)


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

"""Data-quality checks and the collection of rejected values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import first_match


def rejects(df: DataFrame, rules: dict[str, tuple[Column | str, Column | None]], later: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Distinct texts that a cleaning rule could not read: ``rule, raw, rows``.

    ``rules`` maps a rule to its raw and its cleaned column. All rules share one pass, and equal
    texts are merged before the shuffle. Rules without a cleaned column are in ``later``: all their
    texts are counted, and each is read once afterwards.
    """
    failed = [
        F.struct(F.lit(rule).alias("rule"), F.col(raw).alias("raw") if isinstance(raw, str) else raw.alias("raw"),
                 (F.lit(True) if clean is None else clean.isNull()).alias("bad"))
        for rule, (raw, clean) in rules.items()
    ]
    # inline keeps the rules in one generator over the row
    listed = df.select(F.inline(F.array(*failed)))
    counted = listed.filter("bad and raw is not null").groupBy("rule", "raw").agg(F.count(F.lit(1)).alias("rows"))
    if not later:
        return counted
    return counted.filter(first_match([(F.col("rule") == rule, read(F.col("raw")).isNull()) for rule, read in later.items()], F.lit(True)))


def mapping_pairs(df: DataFrame, raw: str, clean: Column) -> DataFrame:
    """Distinct pairs of raw and cleaned text, for review."""
    return df.select(F.col(raw).alias("raw"), clean.alias("clean")).groupBy("raw", "clean").agg(
        F.count(F.lit(1)).alias("rows"))


def key_violations(df: DataFrame, table: str, key: str) -> DataFrame:
    """Primary-key breaches: missing keys and keys used more than once."""
    counted = df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    problem = F.when(F.col("key").isNull(), "missing").when(F.col("rows") > 1, "repeated")
    return counted.withColumn("problem", problem).filter("problem is not null").select(
        F.lit(table).alias("table_name"), "key", "problem", "rows")


def missing_values(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows without a value per column that must have one."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "rows").select(F.lit(table).alias("table_name"), "column_name", "rows")


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, with the number of rows they affect.

    The fact is counted per key before the join, so a hot key is a single row there.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dimension.select(key).distinct(), key, "leftanti").select(
        F.lit(key).alias("key_name"), F.col(key).alias("key"), "rows")


def conform_rejects(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Values that do not fit the type of their warehouse column: ``rule, raw, rows``."""
    return rejects(df, {
        name: (F.col(name).cast("string"), F.col(name).try_cast(kind)) for name, kind in targets.items()
    })

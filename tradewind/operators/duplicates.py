"""Repeated rows: finding, classifying and removing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .patching import possibly_repeated
from .skew import attach_few


def _order_struct(order: list[str]) -> Column:
    return F.struct(*order)


def key_groups(df: DataFrame, keys: list[str], quantity: str | None, order: list[str]) -> DataFrame:
    """All key groups with more than one row (NULL keys are equal): rows, quantity, first row.

    Rows are counted and reduced before the shuffle, so the size of a group does not matter. Of rows
    whose keys' hash stands alone nothing but that hash is exchanged.
    """
    counted = [F.count(F.lit(1)).alias("rows"), F.min(_order_struct(order)).alias("first")]
    if quantity:
        counted.append(F.coalesce(F.sum(F.col(quantity).try_cast("decimal(18,3)")), F.lit(0)).alias("quantity"))
    compared = df.select(*dict.fromkeys([*keys, *order, *([quantity] if quantity else [])]))
    groups = possibly_repeated(compared, keys).groupBy(*keys).agg(*counted).filter("rows > 1")
    if quantity:
        return groups.withColumn("erroneous", F.col("quantity") <= 1)
    return groups.withColumn("quantity", F.lit(None).cast("decimal(28,3)")).withColumn("erroneous", F.lit(True))


def dedupe(df: DataFrame, keys: list[str], quantity: str | None, order: list[str]) -> DataFrame:
    """Keep the first row of every erroneous group and all rows of the others (bulk orders).

    ``order`` must tell all rows apart.
    """
    return once(mark(df, keys, quantity, order))


def duplicate_rows(df: DataFrame, keys: list[str], quantity: str | None, order: list[str]) -> DataFrame:
    """All rows of erroneous groups, for review."""
    return for_review(mark(df, keys, quantity, order))


def mark(df: DataFrame, keys: list[str], quantity: str | None, order: list[str], groups: DataFrame | None = None) -> DataFrame:
    """Adds ``_wrong`` (in an erroneous group) and ``_repeat`` (and not the first row there).

    Groups are made of the compared columns alone, unless ``key_groups`` have been found before, and
    whole rows are not exchanged for the marks.
    """
    found = key_groups(df, keys, quantity, order) if groups is None else groups
    wrong = found.filter("erroneous").withColumnRenamed("first", "_first")
    marked = attach_few(df, wrong, keys, ["_first"], order, F.col("_first").isNotNull())
    return marked.withColumns({
        "_wrong": F.col("_first").isNotNull(),
        "_repeat": F.coalesce(F.col("_first") != _order_struct(order), F.lit(False)),
    }).drop("_first")


def once(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col("_repeat")).drop("_repeat", "_wrong")


def for_review(marked: DataFrame) -> DataFrame:
    return marked.filter("_wrong").drop("_repeat", "_wrong")


def keep_most_complete(df: DataFrame, key: str, order: list[str], ignore: list[str] = ()) -> DataFrame:
    """One row per key: the one with the fewest gaps, then the earliest.

    Spark limits each group to its best row inside every task before the shuffle.
    """
    gaps = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in df.columns if c not in {*order, *ignore}), F.lit(0))
    best = Window.partitionBy(key).orderBy(gaps, *order)
    return df.withColumn("_best", F.row_number().over(best)).filter("_best = 1").drop("_best")

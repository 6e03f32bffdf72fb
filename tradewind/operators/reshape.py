"""Wide and long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ratio


def spread_months(df: DataFrame, row_key: str, month: str, value: Column) -> DataFrame:
    """One row per key with the twelve months as columns ``m01`` .. ``m12``, 0 where empty."""
    wide = df.groupBy(row_key).pivot(month, list(range(1, 13))).agg(value)
    filled = [F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(f"m{m:02d}") for m in range(1, 13)]
    return wide.select(row_key, *filled)


def melt(df: DataFrame, keys: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(keys, values, name, value)


def share_of(value: str, *within: str) -> Column:
    """Share of a value in its group's total, over an already aggregated table."""
    return ratio(F.col(value), F.sum(value).over(Window.partitionBy(*within)))

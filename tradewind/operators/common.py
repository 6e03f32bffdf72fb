"""Small building blocks used by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def revenue(amount: str = "final_amount") -> Column:
    """Sum that is 0, not NULL, where there is nothing to add."""
    return F.coalesce(F.sum(amount), F.lit(0))


def present(df: DataFrame, *names: str) -> DataFrame:
    """Rows whose group keys are all known."""
    return df.dropna(subset=list(names))


def ratio(top: Column, bottom: Column) -> Column:
    """Division in DOUBLE; NULL over zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def mean(amount: str = "final_amount") -> Column:
    """Mean out of the exact sum, so that it does not depend on the order of addition."""
    return ratio(F.sum(amount), F.count(amount))


def scalar(df: DataFrame, value: Column) -> Column:
    """One value of an aggregate over ``df``, as a subquery: no join and no driver round trip."""
    return df.select(value).scalar()


def top(df: DataFrame, count: int, by: str, *ties: str) -> DataFrame:
    """The ``count`` largest rows; ties are broken by the named columns, ascending."""
    return df.orderBy(F.desc(by), *ties).limit(count)


def growth(value: Column, before: Column) -> Column:
    """Change against an earlier value as a fraction; NULL from a zero base."""
    return ratio(value - before, before)

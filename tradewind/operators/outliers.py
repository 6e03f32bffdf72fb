"""Amounts that are too large by powers of ten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions.parsing import first_match
from ..session import staged
from .common import scalar
from .quantiles import exact_quantiles
from .skew import attach_few


def repair_amounts(df: DataFrame, amount: str, reference: str | None, order: list[str]) -> DataFrame:
    """Divide suspicious amounts by 10, 100 or 1000 where that lands near the median of their group (of all rows without ``reference``).

    Adds ``ref_median`` of suspicious rows, ``repair`` (the divisor used, ``flag`` where none fits,
    else NULL) and ``amount_before``. ``order`` must tell all rows apart; whole rows are not exchanged.
    """
    kind = dict(df.dtypes)[amount]
    measured = staged(df.select(*dict.fromkeys([*([reference] if reference else []), amount])), "amounts")
    medians = exact_quantiles(measured, [reference] if reference else [], amount, {"ref_median": 0.5, "_top": 1.0})
    value, middle = F.col(amount).cast("double"), F.col("ref_median")
    suspicious = (middle > 0) & (value > middle * lx.OUTLIER_FACTOR)
    if reference is None:
        known = df.withColumn("ref_median", scalar(medians, F.col("ref_median"))).withColumn("ref_median", F.when(suspicious, middle))
    else:
        # a group whose largest amount is not near suspicious has no such row; other types may hold amounts that the quantiles leave out
        if kind == "decimal(18,4)":
            medians = medians.filter((middle > 0) & (F.col("_top") > middle * (lx.OUTLIER_FACTOR * 0.999)))
        known = attach_few(df, medians, [reference], ["ref_median"], order, suspicious, [amount])
    fits = [
        ((value / d >= middle * lx.REPAIR_LOW) & (value / d <= middle * lx.REPAIR_HIGH), F.lit(str(d)))
        for d in lx.REPAIR_DIVISORS
    ]
    verdict = F.when(middle.isNotNull(), first_match(fits, F.lit("flag")))
    divided = first_match([
        (F.col("repair") == str(d), (F.col(amount) / d).cast(kind)) for d in lx.REPAIR_DIVISORS
    ], F.col(amount))
    return known.withColumn("repair", verdict).withColumns({"amount_before": F.col(amount), amount: divided})


def catalog_price_flags(df: DataFrame, price: str = "price") -> DataFrame:
    """Catalog rows priced above a hundred times the median of all prices."""
    medians = exact_quantiles(df, [], price, {"median_price": 0.5})
    limit = scalar(medians, F.col("median_price") * lx.CATALOG_OUTLIER_FACTOR)
    return df.filter(F.col(price).cast("double") > limit)

"""Shape of numbers: histograms, summaries, box plots, correlation and straight lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ratio, scalar
from .quantiles import exact_quantiles

STAT_DIGITS = 6


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value; all bins are listed.

    Values are counted first, so the range and the bins come from one small table.
    """
    numbers = df.select(F.col(value).try_cast("double").alias("v")).filter("v is not null and not isnan(v)")
    counted = numbers.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    low, high = scalar(counted, F.min("v")), scalar(counted, F.max("v"))
    bounded = counted.select("v", "n", low.alias("low"), high.alias("high"))
    # a single value is its own range; the largest value belongs to the last bin
    place = F.when(F.col("low") == F.col("high"), 1).otherwise(
        F.least(F.width_bucket("v", "low", "high", F.lit(bins)), F.lit(bins))).cast("int")
    filled = bounded.groupBy(place.alias("bin")).agg(F.sum("n").alias("rows"))
    spark = df.sparkSession
    edges = spark.range(1, bins + 1, 1, 1).select(F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    return (
        edges.filter("low is not null").join(filled, "bin", "left")
        .select("bin", (F.col("low") + width * (F.col("bin") - 1)).alias("bin_start"), F.coalesce("rows", F.lit(0)).alias("rows"))
    )


def binned_mean(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Mean of ``y`` over equal-width bins of ``x``."""
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).alias("y")).dropna()
    low, high = scalar(pairs, F.min("x")), scalar(pairs, F.max("x"))
    place = F.least(F.width_bucket(F.col("x"), low, high, F.lit(bins)), F.lit(bins)).cast("int")
    return pairs.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("rows"), ratio(F.sum("y"), F.count("y")).alias("mean_value"))


def describe(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles; ``columns`` gives each its decimal scale.

    All columns are laid under each other, so one plan serves them together.
    """
    cells = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).try_cast(f"decimal(28,{scale})").cast("decimal(32,4)").alias("v"))
        for name, scale in columns.items()
    ]
    long = df.select(F.inline(F.array(*cells)))
    basics = long.groupBy("column_name").agg(
        F.count("v").alias("count"), ratio(F.sum("v"), F.count("v")).alias("mean"),
        F.round(F.stddev_samp(F.col("v").cast("double")), 4).alias("std"),
        F.min("v").cast("double").alias("min"), F.max("v").cast("double").alias("max"))
    quartiles = exact_quantiles(long, ["column_name"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    rounded = quartiles.select("column_name", *[F.round(q, 4).alias(q) for q in ("q25", "q50", "q75")])
    return basics.join(rounded, "column_name", "left").select("column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def box_statistics(df: DataFrame, key: str, value: str, weight: str, scale: int = 2) -> DataFrame:
    """Quartiles per group and the outermost values within 1.5 interquartile ranges.

    Rows are weighted, so the caller can hand over a table that is already counted.
    """
    boxes = exact_quantiles(df, [key], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, scale, weight=weight)
    counted = df.groupBy(key, F.col(value).cast("double").alias("v")).agg(F.sum(weight).alias("n")).filter("v is not null")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    inside = F.col("v").between(low, high)
    return counted.join(boxes, key).groupBy(key, "rows", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are known; NULL when one of them is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.round(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)), STAT_DIGITS)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise correlations in long form, all from one pass."""
    pairs = [(a, b) for a in columns for b in columns]
    wide = df.agg(*[correlation(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs if a <= b])
    cells = [
        F.struct(F.lit(a).alias("row_name"), F.lit(b).alias("column_name"), F.col("|".join(sorted((a, b)))).alias("correlation"))
        for a, b in pairs
    ]
    return wide.select(F.inline(F.array(*cells)))


def straight_line(df: DataFrame, x: Column, y: Column, slope_digits: int = STAT_DIGITS, digits: int = 4) -> DataFrame:
    """Least-squares line: slope, intercept, r2 and rows; NULL for a constant x."""
    a, b = x.cast("double"), y.cast("double")
    return df.agg(
        F.round(F.regr_slope(b, a), slope_digits).alias("slope"), F.round(F.regr_intercept(b, a), digits).alias("intercept"),
        F.round(F.regr_r2(b, a), STAT_DIGITS).alias("r2"), F.regr_count(b, a).alias("rows"),
    )

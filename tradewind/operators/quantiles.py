"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEP = 7
#: Groups of so many rows at most are ordered whole.
SMALL_GROUP = 100_000


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], scale: int = 4, digits: int = 14,
    weight: str | None = None,
) -> DataFrame:
    """Interpolated quantiles per group: the keys, ``rows`` and one DOUBLE column per probability.

    The values are taken as whole numbers of ``10**-scale``. They are first counted per distinct
    value, then located from coarse buckets to fine ones: each step counts the buckets inside the
    ones chosen before, so no task ever orders more than ten million counts, however many rows a
    group has. ``digits`` is the usual number of digits of a value; longer values only make more
    buckets on the first step. With ``weight`` a row stands for that many equal rows. Where no group
    has more than ``SMALL_GROUP`` rows, each is ordered whole instead, with the same result.
    """
    group = keys or ["_all"]
    source = df if keys else df.withColumn("_all", F.lit(0))
    units = F.expr(f"cast(try_cast({value} as decimal(28,{scale})) * {10 ** scale} as bigint)")
    times = F.col(weight) if weight else F.lit(1)
    if keys and not weight:
        known = df.select(*keys, units.alias("_unit")).dropna(subset=[*keys, "_unit"])
        largest = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if largest <= SMALL_GROUP:
            return _ordered(known, keys, probabilities, scale)
    counted = (
        source.select(*group, units.alias("_unit"), times.alias("_times")).dropna(subset=[*group, "_unit"])
        .groupBy(*group, "_unit").agg(F.sum("_times").cast("long").alias("_n"))
    )
    widths = [10 ** power for power in range(_STEP * ((digits - 1) // _STEP), -1, -_STEP)]
    picks = _locate(counted, group, widths, list(probabilities.values()))

    columns = []
    for i, (name, p) in enumerate(probabilities.items()):
        low, high = (F.max(F.when(F.col("pick.slot") == 2 * i + side, F.col("_bucket"))) for side in (0, 1))
        columns.append(_between(low, high, F.lit(float(p)) * (F.max("_rows") - 1), scale).alias(name))
    found = picks.groupBy(*group).agg(F.max("_rows").alias("rows"), *columns)
    return found if keys else found.drop("_all")


def _between(low: Column, high: Column, place: Column, scale: int) -> Column:
    low, high = ((unit.cast("double") / F.lit(10 ** scale)).cast("double") for unit in (low, high))
    return low + (high - low) * (place - F.floor(place))


def _ordered(known: DataFrame, keys: list[str], probabilities: dict[str, float], scale: int) -> DataFrame:
    """The same from the ordered values of each group, for groups of bounded size."""
    held = known.groupBy(*keys).agg(F.sort_array(F.collect_list("_unit")).alias("_units")).withColumn("rows", F.size("_units").cast("long"))
    columns = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("rows") - 1)
        low, high = (F.element_at("_units", edge(place).cast("int") + 1) for edge in (F.floor, F.ceil))
        columns.append(_between(low, high, place, scale).alias(name))
    return held.select(*keys, "rows", *columns)


def _locate(counted: DataFrame, group: list[str], widths: list[int], probabilities: list[float]) -> DataFrame:
    """One row per group and wanted rank, with the unit found there."""
    everything = Window.partitionBy(*group)
    first = counted.groupBy(*group, _bucket("_unit", widths[0])).agg(F.sum("_n").alias("_n"))
    ranks = F.array(*[
        F.struct(F.lit(2 * i + side).alias("slot"), edge(F.lit(float(p)) * (F.col("_rows") - 1)).cast("long").alias("rank"))
        for i, p in enumerate(probabilities) for side, edge in enumerate((F.floor, F.ceil))
    ])
    chosen = _hit(
        first.withColumn("_rows", F.sum("_n").over(everything)).withColumn("_start", F.lit(0).cast("long"))
        .withColumn("_ranks", ranks), group)
    for coarse, fine in zip(widths, widths[1:]):
        parent = [*group, "_parent"]
        inside = (
            counted.withColumn("_parent", F.expr(f"_unit div {coarse}"))
            .join(chosen.withColumnRenamed("_bucket", "_parent"), parent)
            .groupBy(*parent, "_rows", "_start", "_ranks", _bucket("_unit", fine)).agg(F.sum("_n").alias("_n"))
        )
        chosen = _hit(inside, parent).drop("_parent")
    return chosen.select(*group, "_rows", "_bucket", F.explode("_ranks").alias("pick"))


def _bucket(unit: str, width: int) -> Column:
    return F.expr(f"{unit} div {width}").alias("_bucket")


def _hit(buckets: DataFrame, parent: list[str]) -> DataFrame:
    """The buckets that hold a wanted rank, each with its ranks and the number of rows before it."""
    order = Window.partitionBy(*parent).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    ended = buckets.withColumn("_end", F.col("_start") + F.sum("_n").over(order))
    begun = ended.withColumn("_start", F.col("_end") - F.col("_n"))
    mine = F.filter("_ranks", lambda r: (r["rank"] >= F.col("_start")) & (r["rank"] < F.col("_end")))
    return begun.withColumn("_ranks", mine).filter(F.size("_ranks") > 0).drop("_end", "_n")

"""Customer behaviour: recency-frequency-monetary values, cohorts, journeys and segments."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .clusters import fit
from .common import present, ratio, revenue, scalar
from .indexing import with_row_index

#: A customer's chain of so many steps at most is walked by one task.
LONG_CHAIN = 100_000


def rfm(df: DataFrame) -> DataFrame:
    """Per customer: days since the last order (seen from the day after the last of all), number of
    dated orders, revenue."""
    per_customer = present(df, "customer_id").groupBy("customer_id").agg(
        F.max("order_date").alias("last_order"), F.count("order_date").alias("frequency"), revenue().alias("monetary"))
    snapshot = scalar(df, F.max("order_date") + F.expr("interval 1 day"))
    recency = F.extract(F.lit("DAY"), snapshot - F.col("last_order")).cast("int")
    return per_customer.select("customer_id", recency.alias("recency"), "frequency", "monetary")


def recency_quartile(customers: DataFrame) -> DataFrame:
    """Quarter 0..3 of each customer's place by recency, ties placed by customer id.

    Place r of n falls in quarter ceil((r - 1) * 4 / (n - 1)) - 1, the first place in quarter 0.
    """
    placed = with_row_index(customers.filter("recency is not null"), "recency", "customer_id", name="place")
    last = scalar(placed, F.max("place"))
    quarter = F.ceil(F.try_divide((F.col("place") - 1) * 4, last - 1)) - 1
    return placed.select(*customers.columns, F.greatest(F.coalesce(quarter, F.lit(0)), F.lit(0)).cast("int").alias("recency_q"))


def segment(customers: DataFrame, k: int = 4, restarts: int = 10) -> DataFrame:
    """K-means segments over scaled recency, frequency and non-negative monetary value (in units of 0.0001).

    The starts run over the distinct points, weighted by their customers; the best one is kept.
    Segments are numbered by rising mean monetary value.
    """
    usable = customers.dropna(subset=["recency"])
    units = F.coalesce((F.greatest(F.col("monetary"), F.lit(0)) * 10_000).cast("bigint"), F.lit(0))
    numbers = usable.withColumns({"_recency": F.col("recency").cast("bigint"), "_frequency": F.col("frequency").cast("bigint"), "_money": units})
    axes = ["_recency", "_frequency", "_money"]
    numbers = staged(numbers, "points")
    found = fit(numbers.groupBy(*axes).agg(F.count(F.lit(1)).alias("_weight")).transform(lambda df: staged(df, "distinct-points")), axes, "_weight", k, restarts)
    if not found.centres:
        return usable.select("customer_id", "recency", "frequency", "monetary", F.lit(None).cast("int").alias("segment"))
    # k centres live on the driver anyway; rank them by the monetary axis
    rank = {c: r for r, (c, _) in enumerate(sorted(enumerate(found.centres), key=lambda item: item[1][2]))}
    label = F.element_at(F.array(*[F.lit(rank[c]) for c in range(len(rank))]), found.nearest() + 1)
    return numbers.select("customer_id", "recency", "frequency", "monetary", label.alias("segment"))


def scaled_points(customers: DataFrame) -> DataFrame:
    """The three values of each customer in units of their standard deviation around the mean."""
    usable = customers.dropna(subset=["recency"]).withColumn(
        "_money", F.greatest(F.col("monetary").cast("double"), F.lit(0.0)))
    assembled = VectorAssembler(inputCols=["recency", "frequency", "_money"], outputCol="_raw").transform(usable)
    scaled = StandardScaler(inputCol="_raw", outputCol="_point", withMean=True, withStd=True).fit(assembled).transform(assembled)
    axes = vector_to_array("_point")
    return scaled.select("customer_id", *[
        F.round(axes[i], 6).alias(name) for i, name in enumerate(("recency_z", "frequency_z", "monetary_z"))])


def segment_summary(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(
        F.count("customer_id").alias("customers"), ratio(F.sum("recency"), F.count("recency")).alias("avg_recency"),
        ratio(F.sum("frequency"), F.count("frequency")).alias("avg_frequency"),
        ratio(F.sum("monetary"), F.count("monetary")).alias("avg_monetary"))


def customer_months(df: DataFrame, *amounts: Column) -> DataFrame:
    """One row per customer and month with the customer's first month as cohort.

    The window runs over at most one row per calendar month and customer, never over the orders.
    """
    dated = present(df, "customer_id", "order_date")
    months = dated.groupBy("customer_id", F.date_format("order_date", "yyyy-MM").alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"), *amounts)
    return months.withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("customer_id")))


def cohort_counts(df: DataFrame) -> DataFrame:
    """Customers active per cohort month and order month."""
    return customer_months(df).groupBy("cohort_month", "order_month").agg(F.count(F.lit(1)).alias("customers"))


def cohort_retention(df: DataFrame) -> DataFrame:
    """Active customers as a share of the cohort's own size."""
    own = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("order_month") == F.col("cohort_month"), F.col("customers"))).over(own)
    return cohort_counts(df).withColumn("cohort_size", size).select(
        "cohort_month", "order_month", "customers", "cohort_size", ratio(F.col("customers"), F.col("cohort_size")).alias("retention"))


def cohort_value(df: DataFrame) -> DataFrame:
    """Revenue per customer of each cohort, over its whole life."""
    months = customer_months(df, revenue().alias("revenue"))
    return months.groupBy("cohort_month").agg(
        F.sum("revenue").alias("revenue"),
        F.count_if(F.col("order_month") == F.col("cohort_month")).alias("customers"),
    ).withColumn("clv", ratio(F.col("revenue"), F.col("customers")))


def transitions(df: DataFrame, state: str, tie: str) -> DataFrame:
    """How often each state follows another in a customer's orders, taken by date and ``tie``; undated orders come last.

    Rows without a state are skipped and do not break the chain. The steps are staged and counted by
    customer. Chains of ``LONG_CHAIN`` steps at most are walked whole. The steps of longer ones are range-partitioned in
    the order in which they are walked and staged, so a customer's chain is cut only at the borders
    of partitions, however long it is. Inside a partition a step looks at the one before; the chains
    of a customer in neighbouring partitions are stitched together from one first and last state per
    customer and partition.
    """
    order = [F.asc_nulls_last("order_date"), F.asc("tie"), F.asc("state")]
    steps = staged(present(df, "customer_id", state).select("customer_id", "order_date", F.col(tie).alias("tie"), F.col(state).alias("state")), "steps")
    counted = steps.groupBy("customer_id").agg(F.count(F.lit(1)).alias("steps"))
    long = staged(counted.filter(F.col("steps") > LONG_CHAIN).select("customer_id"), "long-chains")

    def tallied(pairs: DataFrame, to_state: str) -> DataFrame:
        return pairs.filter("from_state is not null").groupBy("from_state", F.col(to_state).alias("to_state")).agg(
            F.count(F.lit(1)).alias("transitions"))

    short = steps.join(F.broadcast(long), "customer_id", "left_anti")
    parts = [tallied(short.withColumn("from_state", F.lag("state").over(Window.partitionBy("customer_id").orderBy(*order))), "state")]
    if not long.isEmpty():
        cut = steps.join(F.broadcast(long), "customer_id", "left_semi").repartitionByRange("customer_id", *order)
        placed = staged(cut.withColumn("part", F.spark_partition_id()), "long-steps")
        walked = placed.withColumn("from_state", F.lag("state").over(Window.partitionBy("customer_id", "part").orderBy(*order)))
        place = F.struct(F.col("order_date").isNull().alias("undated"), "order_date", "tie", "state")
        ends = placed.groupBy("customer_id", "part").agg(F.min_by("state", place).alias("first"), F.max_by("state", place).alias("last"))
        seams = ends.withColumn("from_state", F.lag("last").over(Window.partitionBy("customer_id").orderBy("part")))
        parts += [tallied(walked, "state"), tallied(seams, "first")]
    return reduce(DataFrame.unionByName, parts).groupBy("from_state", "to_state").agg(F.sum("transitions").alias("transitions"))

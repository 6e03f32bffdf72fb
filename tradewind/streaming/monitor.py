"""The newest-month monitor, kept up to date over arriving sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATENESS = "2 days"


def sales_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 64) -> DataFrame:
    """Sales from a folder into which Parquet files are dropped."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def daily_sales(sales: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Revenue, orders and approximate customers per day; days close once they are ``lateness`` old.

    State is one small row per open day, so it does not grow with the traffic.
    """
    day = F.window("ts", "1 day")
    return (
        sales.withWatermark("ts", lateness).groupBy(day.alias("day"))
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"), F.approx_count_distinct("customer_id").alias("customers"))
        .select(F.to_date("day.start").alias("day"), "revenue", "orders", "customers")
    )


def keep_daily_sales(sales: DataFrame, table: str, checkpoint: str, lateness: str = LATENESS):
    """Append closed days to a Parquet table; the month's figures are sums over at most 31 rows."""
    return (
        daily_sales(sales, lateness).writeStream.outputMode("append").format("parquet")
        .option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def month_so_far(days: DataFrame, run_rate_days: int = 30) -> DataFrame:
    """Month figures out of the daily table: revenue, orders, days seen and run rate."""
    months = days.groupBy(F.date_format("day", "yyyy-MM").alias("order_ym")).agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("days_seen"))
    latest = months.select(F.max("order_ym")).scalar()
    rate = F.try_divide(F.col("revenue").cast("double"), F.col("days_seen").cast("double")) * run_rate_days
    return months.filter(F.col("order_ym") == latest).withColumn("run_rate", rate)

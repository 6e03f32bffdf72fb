"""Star schema: customers, products, calendar and the transaction fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import lexicon as lx
from ..operators import quality
from ..operators.patching import Patch, patch, possible, possibly_repeated
from ..operators.skew import attach
from ..schemas import warehouse_schema, warehouse_tables
from ..session import staged
from ..sources.resolve import absent, align, pick_first
from ..sources.sinks import publish, published


#: A fact of so many years at most is written by year as its tasks read it.
MOST_YEARS = 32


def _numeric(df: DataFrame, name: str) -> Column:
    """Number of a column that may still be text."""
    return fn.strip_numeric(name) if dict(df.dtypes)[name] == "string" else F.col(name)


def customers(transactions: DataFrame, order: list[str]) -> DataFrame:
    """One row per customer: attributes of the first order, value and number of all orders.

    Everything comes out of one aggregation by customer. Without an amount column the value
    metrics are NULL.
    """
    names = transactions.columns
    known = transactions.filter(F.col("customer_id").isNotNull())
    attributes = [c for c in lx.CUSTOMER_ATTRIBUTES if c in names]
    amount = pick_first(names, lx.CUSTOMER_AMOUNT_NAMES)
    counted = pick_first(names, ["transaction_id", "order_date"])
    measures = [F.count(counted or F.lit(1)).alias("total_orders")]
    if attributes:
        measures.append(F.min_by(F.struct(*attributes), F.struct(*order)).alias("_first"))
    if amount:
        value = _numeric(transactions, amount).try_cast("decimal(18,4)")
        average = F.try_divide(F.sum(value), F.count(value).cast("decimal(12,0)"))
        measures += [F.coalesce(F.sum(value), F.lit(0)).alias("lifetime_value"), average.alias("avg_order_value")]
    else:
        measures += [F.lit(None).cast("decimal(14,2)").alias("lifetime_value"), F.lit(None).cast("decimal(12,2)").alias("avg_order_value")]
    grouped = known.groupBy(F.col("customer_id").cast("string").alias("customer_id")).agg(*measures)
    flat = grouped.select("customer_id", *[F.col(f"_first.{a}").alias(a) for a in attributes], "total_orders",
                          "lifetime_value", "avg_order_value")
    if "is_prime_member" in attributes:
        flat = flat.withColumn("is_prime_member", fn.flag_from_text("is_prime_member"))
    return align(flat, warehouse_schema("customers"))


def calendar(transactions: DataFrame, date: str = "order_date") -> DataFrame:
    """One row per day from the first order's day to the last one's, a started day counting whole."""
    day = F.to_date(date)
    upper = F.max(F.when(F.col(date) > day.cast("timestamp_ntz"), F.date_add(day, 1)).otherwise(day))
    span = transactions.agg(F.min(day).alias("low"), upper.alias("high")).filter("low is not null")
    days = span.select(F.explode(F.sequence("low", "high")).alias("date_id"))
    return align(days.select(
        "date_id", F.year("date_id").alias("year"), F.quarter("date_id").alias("quarter"), F.month("date_id").alias("month"),
        F.date_format("date_id", "MMMM").alias("month_name"), F.weekofyear("date_id").alias("week_of_year"),
        F.dayofmonth("date_id").alias("day_of_month"), F.date_format("date_id", "EEEE").alias("day_name"),
        F.weekday("date_id").isin(5, 6).alias("is_weekend")), warehouse_schema("time_dimension"))


_PROBLEM = "array<struct<rule: string, column_name: string, raw: string>>"


def _problem(rule: str, name: str, raw: Column | None = None) -> Column:
    text = F.lit(None).cast("string") if raw is None else raw.cast("string")
    return F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column_name"), text.alias("raw"))


def _built(df: DataFrame, table: str, numbers: list[str], integers: list[str] = ()) -> tuple[list[Column], Column]:
    """The table's columns out of those of ``df``, and what is lost on the way: misfits and missing values."""
    kinds = dict(df.dtypes)
    built, problems = [], []
    for field in warehouse_schema(table):
        name, kind = field.name, field.dataType.simpleString()
        if name not in kinds:
            built.append(absent(name, kind))
            if not field.nullable:
                problems.append(_problem("missing", name))
            continue
        source = F.col(name)
        value = source
        if kind == "boolean" and kinds[name] != "boolean":
            value = fn.flag_from_text(name)
        elif name in numbers and kinds[name] == "string":
            value = fn.strip_numeric(name)
        if name in integers:
            value = fn.coerce_int(value)
        cast = value if kinds[name] == kind and value is source else value.try_cast(kind)
        built.append(cast.alias(name))
        there = source.isNotNull() & (F.trim(source) != "") if kinds[name] == "string" else source.isNotNull()
        if not (kinds[name] == kind and value is source):
            problems.append(F.when(there & cast.isNull(), _problem("misfit", name, source)))
        if not field.nullable:
            problems.append(F.when(cast.isNull() & ~there, _problem("missing", name)))
    found = F.filter(F.array(*problems), lambda p: p.isNotNull()) if problems else F.array()
    return built, found.cast(_PROBLEM).alias("_problems")


def reviewed(df: DataFrame, table: str, numbers: list[str], integers: list[str] = (), order: list[str] = ()) -> DataFrame:
    """The table's columns, ``_problems`` and ``_order``: each column is built once, and what is lost on the way is told.

    A value that is there but does not fit its column is a ``misfit``, a required one that is not
    there is ``missing``. Blank text is not a value. ``_problems`` that ``df`` has already are kept.
    """
    built, found = _built(df, table, numbers, integers)
    place = F.struct(*order) if order else F.lit(None).cast("string")
    return df.select(*built, "_problems" if "_problems" in df.columns else found, place.alias("_order"))


def _plain(df: DataFrame, table: str) -> DataFrame:
    return df.select(*warehouse_schema(table).names)


def _with_dates(cleaned: DataFrame) -> DataFrame:
    dates = {"order_year": F.year, "order_month": F.month, "order_quarter": F.quarter}
    missing = {name: part("order_date") for name, part in dates.items() if name not in cleaned.columns}
    return cleaned.withColumns(missing) if missing else cleaned


def _reviewed_products(cleaned: DataFrame, order: list[str] = ()) -> DataFrame:
    return reviewed(cleaned, "products", lx.PRODUCT_NUMERIC, order=order)


def products(cleaned: DataFrame) -> DataFrame:
    return _plain(_reviewed_products(cleaned), "products")


def _reviewed_fact(cleaned: DataFrame, order: list[str] = ()) -> DataFrame:
    return reviewed(_with_dates(cleaned), "transactions", lx.TRANSACTION_NUMERIC, lx.TRANSACTION_INTEGERS, order)


def fact(cleaned: DataFrame) -> DataFrame:
    """Transactions in the warehouse layout, year, month and quarter taken from the date if absent."""
    return _plain(_reviewed_fact(cleaned), "transactions")


def _verdicts(reviewed_rows: DataFrame, key: str, known: dict[str, DataFrame] | None = None) -> Patch:
    """The rows that are fit by themselves and may not be loaded all the same, by their place in ``_order``, with their problem.

    Such a row repeats a key (the first row by ``_order`` is loaded), else lacks its row in a dimension. Hashes of keys and
    the keys that a dimension may lack are exchanged, then ``_order`` and key of the few rows that these point to.
    """
    fit = reviewed_rows.filter(F.size("_problems") == 0)
    several = possibly_repeated(fit.select("_order", key), [key])
    firsts = several.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.min("_order").alias("_first")).filter("rows > 1")
    met = attach(several, firsts, [key], ["_first"], spread_by=["_order"])
    again = met.filter(F.col("_order") != F.col("_first"))
    found = [again.select("_order", F.lit(1).alias("_rank"), F.array(_problem("repeated", key, F.col(key))).cast(_PROBLEM).alias("_problems"))]
    for rank, (name, dimension) in enumerate((known or {}).items(), 2):
        there = dimension.select(F.col(name).alias("_known"))
        lacking = staged(fit.select(name).distinct().join(there, F.col(name).eqNullSafe(F.col("_known")), "left_anti"), "orphans")
        perhaps = possible(fit.select("_order", name), [name], lacking, [name])
        lost = attach(perhaps, lacking.withColumn("_lacks", F.lit(True)), [name], ["_lacks"], spread_by=["_order"]).filter("_lacks")
        found.append(lost.select("_order", F.lit(rank).alias("_rank"), F.array(_problem("orphan", name, F.col(name))).cast(_PROBLEM).alias("_problems")))
    verdicts = reduce(DataFrame.unionByName, found).groupBy("_order").agg(F.min_by("_problems", "_rank").alias("problems"))
    return patch(verdicts, ["_order"], ["problems"])


def _judged(reviewed_rows: DataFrame, verdicts: Patch) -> DataFrame:
    """The reviewed rows with all their ``problems``, NULL where a row may be loaded."""
    own = F.when(F.size("_problems") > 0, F.col("_problems"))
    return verdicts.put(reviewed_rows).withColumn("problems", F.coalesce(own, F.col("problems")))


def _needed(names: list[str], order: list[str]) -> list[str]:
    """The columns of cleaned transactions that the warehouse tables are made of."""
    used = {*warehouse_schema("transactions").names, *lx.CUSTOMER_ATTRIBUTES, *lx.CUSTOMER_AMOUNT_NAMES, *order}
    return [name for name in names if name in used]


def build(transactions: DataFrame, catalog: DataFrame, order: list[str], product_order: list[str] | None = None) -> dict[str, DataFrame]:
    """All tables in load order, dimensions before the fact, and the rows that may not be loaded.

    Every row of the input is loaded or rejected. A reject keeps its columns as far as they fit, with
    ``problems``: misfits and missing values (all of a row's), else a repeated key (the first row by
    ``order`` is loaded), else a product that the catalog lacks. ``order`` must tell all rows apart. The transactions
    are staged once with their own problems, and the tables are computed from there when they are written.
    """
    used = _with_dates(transactions.select(*_needed(transactions.columns, order)))
    held = staged(used.select("*", _built(used, "transactions", lx.TRANSACTION_NUMERIC, lx.TRANSACTION_INTEGERS)[1]), "orders")
    items, facts = _reviewed_products(catalog, product_order or catalog.columns), _reviewed_fact(held, order)
    judged_items = _judged(items, _verdicts(items, "product_id"))
    known = judged_items.filter("problems is null")
    judged = _judged(facts, _verdicts(facts, "transaction_id", {"product_id": known}))

    def rejected(df: DataFrame, table: str) -> DataFrame:
        return df.filter("problems is not null").select(*warehouse_schema(table).names, "problems")

    return {
        "products": _plain(known, "products"),
        "customers": customers(held, order),
        "transactions": _plain(judged.filter("problems is null"), "transactions"),
        "time_dimension": calendar(judged.filter("problems is null").select("order_date")),
        "rejected_products": rejected(judged_items, "products"),
        "rejected_transactions": rejected(judged, "transactions"),
    }


def rejects(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, rule, column_name, raw, rows`` over the rejected rows of a built warehouse."""
    listed = [
        tables[f"rejected_{name}"].select(F.lit(name).alias("table_name"), F.explode("problems").alias("p")).select("table_name", "p.*")
        for name in ("products", "transactions")
    ]
    return listed[0].unionByName(listed[1]).groupBy("table_name", "rule", "column_name", "raw").agg(F.count(F.lit(1)).alias("rows"))


def checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Key and reference breaches of a built warehouse: ``check_name, key, rows``."""
    keys = {"products": "product_id", "customers": "customer_id", "transactions": "transaction_id", "time_dimension": "date_id"}
    breaches = [
        quality.key_violations(tables[t], t, k).select(F.concat_ws(":", "table_name", "problem").alias("check_name"), "key", "rows")
        for t, k in keys.items()
    ] + [
        quality.orphans(tables["transactions"], tables[d], k).select(F.concat(F.lit("orphan:"), "key_name").alias("check_name"), "key", "rows")
        for d, k in (("products", "product_id"), ("customers", "customer_id"))
    ]
    whole = breaches[0]
    for part in breaches[1:]:
        whole = whole.unionByName(part)
    return whole


def load(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Publish all tables as Parquet, dimensions first, the fact by order year; return them as read back.

    Tasks that read whole splits write files large enough for a few years each, so the fact is exchanged for more years only.
    """
    years = tables["transactions"].select("order_year").distinct().limit(MOST_YEARS + 1).count()
    publish(spark, tables, folder, {"transactions": "order_year"}, rebalanced=years > MOST_YEARS)
    return loaded(spark, folder)


def loaded(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the warehouse's current version."""
    return published(spark, folder)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in warehouse_tables()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole

"""Raw transactions and products to cleaned tables, with everything that was rejected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import lexicon as lx
from ..operators import duplicates, outliers, quality
from ..operators.dictionary import Dictionaries, Rules, learn, looked_up
from ..operators.indexing import with_row_index
from ..operators.reshape import melt
from ..session import staged
from ..sources.readers import union_chunks
from ..sources.resolve import pick_containing, pick_first, with_snake_headers

MONEY = "decimal(18,4)"


@dataclass(frozen=True)
class Cleaned:
    """A cleaned table, and on demand the texts its rules rejected and the rows set aside for review."""

    table: DataFrame
    find_rejects: Callable[[], DataFrame]
    find_review: Callable[[], dict[str, DataFrame]]

    @property
    def rejects(self) -> DataFrame:
        return self.find_rejects()

    @property
    def review(self) -> dict[str, DataFrame]:
        return self.find_review()


@dataclass(frozen=True)
class CleanedTransactions(Cleaned):
    """Also the table with its repair marks and the groups of equal rows."""

    repaired: DataFrame
    duplicate_groups: DataFrame


def money(text: Column | str) -> Column:
    return fn.clean_price(text).try_cast(MONEY)


def transaction_rules(names: list[str]) -> Rules:
    """Cleaned column -> (raw column, function), for the columns that are there."""
    rules: Rules = {}
    date = pick_first(names, ["order_date"]) or next(iter(pick_containing(names, "date")), None)
    if date:
        rules["order_date"] = (date, fn.clean_date)
    price = pick_first(names, lx.RAW_PRICE_NAMES)
    if price:
        rules["original_price_inr_clean"] = (price, money)
    amount = pick_first(names, ["final_amount", "final_amount_inr"])
    if amount:
        rules["final_amount"] = (amount, money)
    for rating in pick_containing(names, "rating"):
        rules[rating] = (rating, fn.clean_rating)
    city = pick_first(names, ["customer_city"]) or next(iter(pick_containing(names, "city")), None)
    if city:
        rules[city] = (city, fn.clean_city)
    for flag in (n for n in names if n.startswith("is_") and ("prime" in n or "festival" in n)):
        rules[flag] = (flag, fn.parse_flag)
    if "delivery_days" in names:
        rules["delivery_days"] = ("delivery_days", fn.clean_delivery_days)
    payment = payment_column(names)
    if payment:
        rules[payment] = (payment, fn.clean_payment)
    return rules


def of_few_texts(rules: Rules) -> list[str]:
    """The rules whose columns usually hold few distinct texts: all but prices and amounts."""
    return [rule for rule, (_, read) in rules.items() if read is not money]


def payment_column(names: list[str]) -> str | None:
    likely = [n for n in names if "payment" in n or ("pay" in n and "method" in n)]
    return likely[0] if likely else pick_first(names, lx.RAW_PAYMENT_NAMES)


def _raw_of(name: str) -> str:
    return f"_raw_{name}"


@dataclass(frozen=True)
class Values:
    """A staged raw table in which the rules of many texts have been applied, and dictionaries for the others."""

    held: DataFrame
    names: list[str]
    in_rows: Rules
    known: Dictionaries

    def table(self, *names: str) -> DataFrame:
        """The cleaned columns (those named, or all); unreadable flags count as false."""
        wanted = list(names) or self.names
        sources = [raw for rule, (raw, _) in self.known.rules.items() if rule in wanted]
        kept = [c for c in self.held.columns if c in wanted or c in sources]
        found = looked_up(self.held.select(*kept), self.known, wanted)
        flags = {rule for rule, (_, read) in (self.in_rows | self.known.rules).items() if read is fn.parse_flag}
        return found.select(*[F.coalesce(n, F.lit(False)).alias(n) if n in flags else n for n in wanted])

    def rejects(self) -> DataFrame:
        """Distinct texts that the rules could not read, with the rows that hold them."""
        in_rows = quality.rejects(self.held, {rule: (_raw_of(rule), F.col(rule)) for rule in self.in_rows})
        return self.known.rejects().unionByName(in_rows) if self.in_rows else self.known.rejects()

    def pairs(self, column: str) -> DataFrame:
        """Distinct pairs of raw and cleaned text of a column, for review."""
        if column in self.in_rows:
            return quality.mapping_pairs(self.held, _raw_of(column), F.col(column))
        raw, _ = self.known.rules[column]
        return quality.mapping_pairs(looked_up(self.held.select(raw, F.col(raw).alias("_raw")), self.known, [column]), "_raw", F.col(column))


def values(raw: DataFrame, few: list[str] | None = None) -> Values:
    """All column rules over a raw table, which is staged once.

    ``few`` names the cleaned columns whose raw texts repeat so much that each distinct one is read once
    (``of_few_texts`` by default); the other rules are applied row by row before the table is staged.
    """
    rules = transaction_rules(raw.columns)
    few = of_few_texts(rules) if few is None else few
    in_rows = {rule: rules[rule] for rule in rules if rule not in few}
    read = {rule: function(F.col(source)) for rule, (source, function) in in_rows.items()}
    held = staged(raw.withColumns({_raw_of(rule): F.col(source) for rule, (source, _) in in_rows.items()}).withColumns(read), "raw-values")
    names = raw.columns + [rule for rule in rules if rule not in raw.columns]
    return Values(held, names, in_rows, learn(held, {rule: rules[rule] for rule in rules if rule in few}))


def clean_values(raw: DataFrame) -> DataFrame:
    """The table with all column rules applied."""
    return values(raw).table()


def transaction_rejects(raw: DataFrame, few: list[str] | None = None) -> DataFrame:
    """Distinct texts that the rules could not read: ``rule, raw, rows``.

    One pass counts all texts of columns with few of them, read once each afterwards, and the
    unreadable ones among the others.
    """
    rules = transaction_rules(raw.columns)
    few = of_few_texts(rules) if few is None else few
    return quality.rejects(raw, {rule: (source, None if rule in few else read(F.col(source))) for rule, (source, read) in rules.items()},
                           {rule: rules[rule][1] for rule in few})


def duplicate_key(names: list[str]) -> list[str]:
    return [k for k in lx.DUPLICATE_KEY if k in names]


def clean_transactions(raw: DataFrame, order: list[str]) -> CleanedTransactions:
    """Whole transaction pipeline: values, duplicates, price repair. ``order`` tells rows apart.

    The raw table is staged once. Columns of few texts are read through dictionaries; the duplicate
    and outlier steps measure on row keys and a few columns. What they find, repeated rows and
    repairs, is put into the whole rows when an output is written, so these are never exchanged.
    """
    named = with_snake_headers(raw)
    read = values(named)
    names = read.names
    whole = read.table()
    key, quantity = duplicate_key(names), pick_first(names, lx.RAW_QUANTITY_NAMES)
    compared = read.table(*dict.fromkeys([*order, *key, *([quantity] if quantity else [])]))
    groups = staged(duplicates.key_groups(compared, key, quantity, order), "groups")
    marked = duplicates.mark(whole, key, quantity, order, groups)
    amount = pick_first(names, ["final_amount"]) or pick_containing(names, "price")[0]
    reference = pick_first(names, ["product_id"]) or next(iter(pick_containing(names, "category")), None)
    repaired = outliers.repair_amounts(duplicates.once(marked), amount, reference, order)
    return CleanedTransactions(
        table=repaired.drop("ref_median", "repair", "amount_before"), find_rejects=read.rejects, repaired=repaired,
        duplicate_groups=groups,
        find_review=lambda: {
            "duplicates": duplicates.for_review(marked),
            "repaired_amounts": repaired.filter("repair <> 'flag'"),
            "flagged_amounts": repaired.filter("repair = 'flag'"),
            **{f"{kind}_pairs": read.pairs(column) for kind, column in _paired(names).items()},
        })


def _paired(names: list[str]) -> dict[str, str]:
    """Columns whose raw and cleaned texts are listed side by side for review."""
    rating, payment = next(iter(pick_containing(names, "rating")), None), payment_column(names)
    return {kind: column for kind, column in (("rating", rating), ("payment", payment)) if column}


def with_product_ids(raw: DataFrame, order: list[str]) -> DataFrame:
    """Normalised ``product_id``; blanks become MISSING_1.., a table without ids gets PID_1.. ."""
    source = pick_first(raw.columns, lx.RAW_ID_NAMES)
    if source is None:
        numbered = with_row_index(raw, *order, name="_n")
        return numbered.select(F.concat(F.lit("PID_"), "_n").alias("product_id"), *raw.columns)
    rest = [c for c in raw.columns if c != source]
    normal = raw.select(fn.clean_product_id(source).alias("product_id"), *rest)
    # only the rows without an id are sorted and numbered
    blank = with_row_index(normal.filter("product_id is null"), *order, name="_n")
    return normal.filter("product_id is not null").unionByName(
        blank.select(F.concat(F.lit("MISSING_"), "_n").alias("product_id"), *rest))


def product_values(raw: DataFrame, order: list[str]) -> DataFrame:
    """All column rules for the catalog."""
    df = with_product_ids(raw, order)
    name = next(iter(pick_containing(df.columns, "name")), None)
    if name and name != "product_name":
        df = df.withColumnRenamed(name, "product_name")
    prices = [p for p in lx.CATALOG_PRICE_NAMES if p in df.columns]
    brand = next(iter(pick_containing(df.columns, "brand")), None)
    category = next(iter(pick_containing(df.columns, "category")), None)
    nothing = F.lit(None)
    values = {
        "product_name": fn.clean_product_name("product_name") if name else F.col("product_id"),
        **{f"{p}_clean": money(p) for p in prices},
        "price": money(prices[0]) if prices else nothing.cast(MONEY),
        "brand": fn.clean_brand(brand) if brand else nothing.cast("string"),
        "category": fn.clean_category(category) if category else nothing.cast("string"),
        **{c: fn.blank_to_null(c) for c in pick_containing(df.columns, "image", "img")},
        **{c: fn.clean_rating(c) for c in pick_containing(df.columns, "rating")},
    }
    return df.withColumns(values)


def product_rejects(raw: DataFrame) -> DataFrame:
    names = raw.columns
    prices = {f"{p}_clean": (p, money(p)) for p in lx.CATALOG_PRICE_NAMES if p in names}
    ratings = {c: (c, fn.clean_rating(c)) for c in pick_containing(names, "rating")}
    return quality.rejects(raw, {**prices, **ratings})


def clean_products(raw: DataFrame, order: list[str]) -> Cleaned:
    """Whole catalog pipeline: ids, names, prices, brands, categories, then one row per product."""
    named = with_snake_headers(raw)
    table = duplicates.keep_most_complete(product_values(named, order), "product_id", order)
    return Cleaned(table, lambda: product_rejects(named), lambda: {
        "extreme_prices": outliers.catalog_price_flags(table),
        "categories": table.select("product_id", "product_name", "category").distinct(),
    })


def cleaning_summary(
    transactions: DataFrame, products: DataFrame, transaction_order: list[str], product_order: list[str],
) -> DataFrame:
    """Metric and value: rows kept, distinct rejected texts per rule, rows set aside for review.

    Every stage is counted in one pass of its own instead of once per review table.
    """
    done, catalog = clean_transactions(transactions, transaction_order), clean_products(products, product_order)
    repairs = done.repaired.agg(
        F.count(F.lit(1)).alias("transactions_rows"), F.count_if(F.col("repair") != "flag").alias("review_repaired_amounts"),
        F.count_if(F.col("repair") == "flag").alias("review_flagged_amounts"))
    repeated = done.duplicate_groups.filter("erroneous").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("review_duplicates"))
    kept = catalog.table.agg(F.count(F.lit(1)).alias("products_rows"), F.count("category").alias("products_with_category"))
    extreme = catalog.review["extreme_prices"].agg(F.count(F.lit(1)).alias("review_extreme_prices"))

    def per_rule(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("rule").agg(F.count(F.lit(1)).alias("value")).select(F.concat(F.lit(prefix), "rule").alias("metric"), "value")

    counted = [melt(df, [], df.columns, "metric", "value") for df in (repairs, repeated, kept, extreme)]
    counted += [per_rule(done.rejects, "rejected_"), per_rule(catalog.rejects, "rejected_product_")]
    return union_chunks(counted)

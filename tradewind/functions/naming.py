"""Free text to a fixed vocabulary: cities, payment methods, categories, brands and names."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx
from .parsing import as_column, first_match, let


def title_case(value: Column | str) -> Column:
    """Capital after every non-letter, the rest in lower case: ``co-op 3rd`` -> ``Co-Op 3Rd``."""
    words = F.split(F.lower(as_column(value)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")


def _squeeze(text: Column, drop: str, put: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, drop, put), r"\s+", " "))


def clean_city(value: Column | str) -> Column:
    """Standard city name: exact alias, else first alias contained, else title case."""
    aliases = F.create_map(*[F.lit(part) for pair in lx.CITY_ALIASES.items() for part in pair])
    squeezed = _squeeze(F.lower(as_column(value)), r"[^a-z0-9\s]", " ")

    def name(text: Column) -> Column:
        within = [(text.contains(alias), F.lit(city)) for alias, city in lx.CITY_ALIASES.items()]
        return F.when(~text.isin(lx.MISSING_WORDS), F.coalesce(F.try_element_at(aliases, text), first_match(within, title_case(text))))

    return let(squeezed, name)


def clean_payment(value: Column | str) -> Column:
    """Payment family by the first keyword group that matches, else title case."""
    def family(text: Column) -> Column:
        groups = [(text.rlike("|".join(words)), F.lit(name)) for name, words in lx.PAYMENT_GROUPS.items()]
        return F.when(text.isNotNull(), first_match(groups, F.trim(title_case(text))))

    return let(F.regexp_replace(F.lower(as_column(value)), r"[^a-z0-9 ]", " "), family)


def clean_category(value: Column | str) -> Column:
    """Product category by the first synonym contained, else title case."""
    def name(text: Column) -> Column:
        within = [(text.contains(word), F.lit(label)) for word, label in lx.CATEGORY_SYNONYMS.items()]
        return F.when(text.isNotNull(), first_match(within, title_case(text)))

    return let(_squeeze(F.lower(as_column(value)), r"[^a-z0-9\s&]", " "), name)


def clean_brand(value: Column | str) -> Column:
    """Brand without punctuation, in title case."""
    return title_case(_squeeze(F.trim(as_column(value)), r"[^A-Za-z0-9 &\-]", ""))


def clean_product_id(value: Column | str) -> Column:
    """Trimmed upper-case id; NULL where blank, to be numbered by the caller."""
    return F.upper(F.nullif(F.trim(as_column(value).cast("string")), F.lit("")))


def clean_product_name(value: Column | str) -> Column:
    return F.coalesce(F.nullif(F.trim(as_column(value)), F.lit("")), F.lit("UNKNOWN_PRODUCT"))


def age_bucket(age: Column | str) -> Column:
    """Label of the right-closed age interval, NULL outside all of them."""
    years = as_column(age)
    spans = zip(lx.AGE_EDGES, lx.AGE_EDGES[1:], lx.AGE_LABELS)
    return first_match([((years > low) & (years <= high), F.lit(label)) for low, high, label in spans])


def year_month(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM")


def year_month_label(year: Column | str, month: Column | str) -> Column:
    """``yyyy-MM`` from whole numbers."""
    return F.format_string("%d-%02d", as_column(year), as_column(month))


def format_currency(value: Column | str) -> Column:
    """``₹1,234`` without fraction, ``N/A`` when missing."""
    amount = as_column(value)
    shown = F.concat(F.when(amount < 0, F.lit("₹-")).otherwise(F.lit("₹")), F.format_number(F.abs(F.bround(amount, 0)), 0))
    return F.coalesce(shown, F.lit("N/A"))


def format_percent(value: Column | str, digits: int = 1) -> Column:
    """Share as percent text, ``N/A`` when missing."""
    return F.coalesce(F.concat(F.format_number(as_column(value) * 100, digits), F.lit("%")), F.lit("N/A"))


# --- column headers (driver side, names only) ---------------------------------------------------


def snake_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def ascii_header(name: str) -> str:
    """ASCII snake case: no byte-order mark, accents folded, other runs to one underscore."""
    folded = unicodedata.normalize("NFKD", name)
    plain = "".join(ch for ch in folded if ch.isascii()).lower()
    return "_".join(re.findall(r"[0-9a-z]+", plain))

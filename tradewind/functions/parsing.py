"""Text to value: dates, prices, ratings, delivery days, flags and plain numbers.

Every function takes a column (or its name) and returns a column. Text that cannot be read gives
NULL, never an exception, with ANSI mode on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as lx


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_match(branches: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """CASE over (condition, value) pairs in order."""
    head, *rest = branches
    case = reduce(lambda c, b: c.when(*b), rest, F.when(*head))
    return case if otherwise is None else case.otherwise(otherwise)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def to_number(value: Column | str) -> Column:
    """Text as DOUBLE; what is not a number, NaN and infinities included, becomes NULL."""
    number = as_column(value).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def null_tokens(value: Column | str) -> Column:
    """NULL for the tokens that CSV files use for missing values."""
    text = as_column(value)
    return F.when(~F.trim(text).isin(lx.NA_TOKENS), text)


def blank_to_null(value: Column | str) -> Column:
    """NULL for blank text and the word ``nan`` (image and link columns)."""
    text = as_column(value)
    return F.when(~text.isin("", "nan"), text)


def clean_date(value: Column | str) -> Column:
    """Calendar date out of mixed day-first formats; an incomplete date is NULL.

    The shape of the text decides how it is read. Dates in figures are put into ISO order and cast,
    which is much cheaper than trying one format after the other. Only a text that is no such date
    has the name of the day and the time of day removed and is looked at again, in figures or words.
    """
    def figures(text: Column, shape: str, iso: str) -> Column:
        return F.regexp_replace(text, shape, iso).try_cast("date")

    def short_year(date: Column) -> Column:
        return F.when(F.year(date) > lx.LAST_TWO_DIGIT_YEAR, F.add_months(date, -1200)).otherwise(date)

    def words(text: Column, formats: list[str]) -> Column:
        return F.coalesce(*[F.to_date(F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats])

    def spoken(text: Column) -> Column:
        short = (text.rlike(lx.SHORT_WORD_DATE), let(words(text, lx.SHORT_WORD_FORMATS), short_year))
        return first_match([short, *[(text.rlike(s), words(text, f)) for s, f in lx.WORD_DATE_FORMATS.items()]])

    def in_figures(text: Column) -> list[tuple[Column, Column]]:
        shapes = [(text.rlike(shape), figures(text, shape, iso)) for shape, iso in lx.FIGURE_DATES.items()]
        return [*shapes, (text.rlike(lx.SHORT_FIGURE_DATE), let(figures(text, lx.SHORT_FIGURE_DATE, lx.SHORT_FIGURE_ISO), short_year))]

    def in_words(text: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(text, lx.ORDINAL, "$1"), lx.DATE_SEPARATORS, " ")
        return let(F.trim(F.regexp_replace(plain, lx.SEPTEMBER, "Sep")), spoken)

    def bare(text: Column) -> Column:
        return let(F.trim(F.regexp_replace(F.regexp_replace(text, lx.WEEKDAY, ""), lx.TIME_OF_DAY, "")), lambda date: first_match(in_figures(date), in_words(date)))

    def read(text: Column) -> Column:
        date_time = (text.rlike(lx.ISO_DATE_TIME), F.to_date(F.try_to_timestamp(text)))
        return first_match([*in_figures(text), date_time], bare(text))

    return let(F.trim(as_column(value)), read)


def iso_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def clean_price(value: Column | str) -> Column:
    """Price text as DOUBLE, with Indian and short-scale units."""
    factors = F.create_map(*[F.lit(part) for pair in lx.PRICE_UNITS.items() for part in pair])

    def digits_only(digits: Column) -> Column:
        # every dot after the first one goes
        fraction = F.translate(F.regexp_extract(digits, r"\.(.*)", 1), ".", "")
        return F.concat(F.substring_index(digits, ".", 1), F.lit("."), fraction).try_cast("double")

    def worded(bare: Column) -> Column:
        factor = F.try_element_at(factors, F.lower(F.regexp_extract(bare, lx.PRICE_UNIT, 2)))
        scaled = F.regexp_extract(bare, lx.PRICE_UNIT, 1).try_cast("double") * factor
        number = let(F.regexp_replace(bare, r"[^0-9.\-]", ""), digits_only)
        return F.when(bare.rlike(lx.PLAIN_NUMBER), bare.try_cast("double")).otherwise(F.coalesce(scaled, number))

    bare = F.translate(F.regexp_replace(F.trim(as_column(value)), lx.CURRENCY_PREFIX, ""), ",", "")
    return let(F.trim(as_column(value)), lambda text: (
        F.when(text.rlike(lx.PLAIN_NUMBER), text.try_cast("double"))
        .when(~text.rlike(lx.PRICE_ABSENT), let(bare, worded))))


def clean_rating(value: Column | str) -> Column:
    """Rating text on a scale of 1 to 5."""
    def number(text: Column, pattern: str, part: int) -> Column:
        return F.regexp_extract(text, pattern, part).try_cast("double")

    def fraction(score: Column, base: Column) -> Column:
        return F.when((base > 0) & (base != 5), F.try_divide(score, base) * 5.0).otherwise(score)

    def single(v: Column) -> Column:
        return F.when(v.between(1.0, 5.0), v).when(v <= 10, F.least(F.lit(5.0), v / 2.0))

    return let(F.trim(as_column(value)), lambda text: F.when(
        text.rlike(lx.RATING_FRACTION), fraction(number(text, lx.RATING_FRACTION, 1), number(text, lx.RATING_FRACTION, 2))
    ).otherwise(let(number(text, lx.RATING_NUMBER, 1), single)))


def clean_delivery_days(value: Column | str) -> Column:
    """Delivery promise in days: the median of the numbers named, rounded half to even."""
    def median(days: Column) -> Column:
        count = F.size(days)
        low = F.try_element_at(days, F.floor((count + 1) / 2).cast("int"))
        high = F.try_element_at(days, F.floor((count + 2) / 2).cast("int"))
        return F.when(count > 0, F.bround((low + high) / 2.0))

    def believed(days: Column) -> Column:
        return F.when(days <= lx.MAX_DELIVERY_DAYS, days.try_cast("int"))

    text = F.lower(as_column(value))
    numbers = F.array_sort(F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda d: d.cast("double")))
    return F.when(text.contains("same"), F.lit(0)).otherwise(let(let(numbers, median), believed))


def parse_flag(value: Column | str) -> Column:
    """Flag words as BOOLEAN, NULL when the text says neither."""
    return let(F.lower(F.trim(as_column(value).cast("string"))), lambda text: (
        F.when(text.isin(lx.TRUE_WORDS), True)
        .when(text.isin(lx.FALSE_WORDS), False)
        .when(text.contains("prime"), True)
        .otherwise(to_number(text) != 0)))


def clean_bool(value: Column | str) -> Column:
    """Flag words as BOOLEAN; unreadable and missing text counts as false."""
    return F.coalesce(parse_flag(value), F.lit(False))


def lenient_flag(value: Column | str) -> Column:
    """True for the usual affirmative words, false for everything else."""
    return F.coalesce(F.lower(as_column(value).cast("string")).isin(lx.LENIENT_TRUE_WORDS), F.lit(False))


def flag_from_text(value: Column | str) -> Column:
    """Strict flag for warehouse columns: true/false/1/0, otherwise NULL."""
    text = F.lower(F.trim(as_column(value).cast("string")))
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def strip_numeric(value: Column | str) -> Column:
    """Number left after removing everything but digits, dot and minus."""
    return F.regexp_replace(as_column(value).cast("string"), r"[^0-9.\-]", "").try_cast("double")


def coerce_int(value: Column | str) -> Column:
    """Whole numbers as INT; fractions and text give NULL."""
    number = to_number(value)
    return F.when(number == F.floor(number), number.try_cast("int"))


def to_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """DECIMAL(precision, scale), rounded half up; NULL when it does not fit."""
    return as_column(value).try_cast(f"decimal({precision},{scale})")

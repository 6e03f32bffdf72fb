"""Fill-in-middle by counted quantifiers.

Method: ``regexp_count`` gives the number n of a text's units (a run of A-Z and a-z, or any other
single code point). Two numbers drawn from the row's id give cuts a <= b in 0..n. A pattern is made for the
row in which ``unit{a}`` and ``unit{b-a}`` are possessive groups, so one match captures prefix, middle and suffix,
and the replacement, also made for the row, puts them down in the order of the form. A possessive group never
gives back what it took: the engine walks such a group in a loop, with neither backtracking nor a stack
that grows with the text. All of it is column functions of one row; nothing is shuffled.

Defined results: a null text is an empty one, which is plain; so is a text that holds one of the markers;
the number of a null id is drawn from an empty id; repeated rows get equal results; prefix, middle and
suffix may each be empty; texts of any length are cut whole; an empty table gives no rows; other columns
pass unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

UNIT = "[A-Za-z]++|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are transformed, and of 100 transformed ones so many have the suffix first.
RATE, SUFFIX_FIRST = 90, 20
_MARK = len(PREFIX)


def draws(key: Column, seed: int = 1, count: int = 4) -> list[Column]:
    """Numbers below 2^32 that hang on the row's id and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(count)]


def pattern(first: Column, second: Column) -> Column:
    """The row's pattern: so many units, so many more, the rest."""
    unit = f"(?:{UNIT})"
    return F.concat(F.lit(r"(?s)\A(" + unit + "{"), first.cast("string"), F.lit("}+)(" + unit + "{"), second.cast("string"), F.lit(r"}+)(.*)\z"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made of."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def infilled(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[DataFrame, list[str]]:
    """All columns and five more: n, form, output, and the code points of prefix and middle (null if plain); their names."""
    n, form, output, prefix_chars, middle_chars, whole, a, b, free = names = fresh(docs, "n", "form", "output", "prefix_chars", "middle_chars", "whole", "a", "b", "free")
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    counted = docs.withColumn(whole, F.coalesce(F.col("text"), F.lit("")))
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    counted = counted.withColumn(n, F.regexp_count(whole, F.lit(UNIT)).cast("long")).withColumn(free, ~marked & (F.col(n) > 0))
    kept = F.when(~F.col(free) | (h3 % 100 >= rate), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    cut = counted.withColumn(form, kept).withColumn(a, F.least(h1 % (F.col(n) + 1), h2 % (F.col(n) + 1))).withColumn(b, F.greatest(h1 % (F.col(n) + 1), h2 % (F.col(n) + 1)))
    order = F.when(F.col(form) == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    moved = F.regexp_replace(F.col(whole), pattern(F.col(a), F.col(b) - F.col(a)), order)
    made = cut.withColumn(output, F.when(F.col(form) == "plain", F.col(whole)).otherwise(moved))
    # no marker is in the text and none overlaps another, so the first of each is the one put there
    at = {mark: F.locate(mark, F.col(output)) for mark in (PREFIX, SUFFIX, MIDDLE)}
    before = F.when(F.col(form) == "psm", at[SUFFIX] - at[PREFIX]).when(F.col(form) == "spm", at[MIDDLE] - at[PREFIX]) - _MARK
    after = F.when(F.col(form) != "plain", F.length(output) - at[MIDDLE] - _MARK + 1)
    out = made.withColumn(prefix_chars, before.cast("long")).withColumn(middle_chars, after.cast("long"))
    return out.select(*docs.columns, *names[:5]), names[:5]


ORACLE = r"""
WITH cut AS (
    SELECT doc_id, text, units, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
           ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
                 sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents)
), parted AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
           array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
           array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
    FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""

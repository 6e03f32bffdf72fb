"""Column rules that read each distinct text once.

A column of few distinct texts (cities, flags, dates written in many ways) is cleaned through a
dictionary: its texts are counted, each is read once, and the rows fetch the values by broadcast
joins. The counts also tell which texts a rule could not read, and how often they stand in the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: Cleaned column -> (raw column, how its text is read).
Rules = dict[str, tuple[str, Callable[[Column], Column]]]

#: What all dictionaries of a table together may hold to be sent to every task.
MOST_TEXTS, MOST_BYTES = 200_000, 16 << 20


@dataclass(frozen=True)
class Dictionaries:
    """``table``: rule, raw text, rows, and one column of values per rule; ``sent``: the rules whose texts are few enough."""

    table: DataFrame
    rules: Rules
    values: dict[str, str]
    sent: list[str]

    def rejects(self) -> DataFrame:
        """Texts without a value: ``rule, raw, rows``."""
        unread = [(F.col("rule") == rule) & F.col(value).isNull() for rule, value in self.values.items()]
        return self.table.filter(F.greatest(*unread, F.lit(False), F.lit(False))).select("rule", "raw", "rows")


def counted_texts(df: DataFrame, sources: dict[str, str]) -> DataFrame:
    """``rule, raw, rows``: the distinct texts of several columns in one pass, merged before the shuffle."""
    listed = df.select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(raw).alias("raw")) for rule, raw in sources.items()])))
    return listed.filter("raw is not null").groupBy("rule", "raw").agg(F.count(F.lit(1)).alias("rows"))


def read_once(counted: DataFrame, rules: Rules, values: dict[str, str]) -> DataFrame:
    """``counted`` with one column of values per rule, each read from the rule's own texts alone."""
    return counted.withColumns({values[rule]: F.when(F.col("rule") == rule, read(F.col("raw"))) for rule, (_, read) in rules.items()})


def learn(df: DataFrame, rules: Rules, most_texts: int = MOST_TEXTS, most_bytes: int = MOST_BYTES) -> Dictionaries:
    """The dictionaries of the rules' columns, as they stand in the table.

    Rules are taken from the fewest texts up, as long as all that are taken stay within both bounds.
    A rule beyond them is applied row by row (``looked_up``), with the same values.
    """
    values = {rule: f"value_{i}" for i, rule in enumerate(rules)}
    if not rules:
        return Dictionaries(df.sparkSession.createDataFrame([], "rule string, raw string, rows long"), rules, values, [])
    table = staged(read_once(counted_texts(df, {rule: raw for rule, (raw, _) in rules.items()}), rules, values), "dictionary")
    sizes = table.groupBy("rule").agg(F.count(F.lit(1)).alias("texts"), F.sum(F.octet_length("raw")).alias("bytes")).collect()  # a row per rule
    known = {r["rule"]: (r["texts"], r["bytes"]) for r in sizes}
    sent, texts, held = [], 0, 0
    for rule in sorted(rules, key=lambda r: known.get(r, (0, 0))):
        more, longer = known.get(rule, (0, 0))
        if texts + more <= most_texts and held + longer <= most_bytes:
            sent.append(rule)
            texts, held = texts + more, held + longer
    return Dictionaries(table, rules, values, sent)


def looked_up(df: DataFrame, known: Dictionaries, names: list[str] | None = None) -> DataFrame:
    """The table with the cleaned columns (those named, or all): in place of a column of that name, else behind the others."""
    wanted = [rule for rule in known.rules if names is None or rule in names]
    made: dict[str, Column] = {}
    met = df
    for i, rule in enumerate(wanted):
        raw, read = known.rules[rule]
        if rule not in known.sent:
            made[rule] = read(F.col(raw))
            continue
        entry = known.table.filter(F.col("rule") == rule).select(F.col("raw").alias(f"_text_{i}"), F.col(known.values[rule]).alias(f"_value_{i}"))
        met = met.join(F.broadcast(entry), F.col(raw) == F.col(f"_text_{i}"), "left")
        made[rule] = F.col(f"_value_{i}")
    kept = [made.pop(c).alias(c) if c in made else F.col(c) for c in df.columns]
    return met.select(*kept, *[value.alias(rule) for rule, value in made.items()])

"""Finding columns by role. Works on names alone: no job is started."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as lx
from ..functions.naming import ascii_header, snake_header

SHORTEST_FUZZY = 4


def with_snake_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_header, df.columns))


def with_ascii_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*map(ascii_header, df.columns))


def pick_first(names: list[str], candidates: list[str]) -> str | None:
    """The first candidate that is present under exactly this name."""
    present = set(names)
    return next((c for c in candidates if c in present), None)


def pick_containing(names: list[str], *parts: str) -> list[str]:
    """All names that contain any of the parts."""
    return [n for n in names if any(part in n for part in parts)]


def find_column(names: list[str], candidates: list[str]) -> str | None:
    """Look a column up by meaning: same cleaned name, same letters, one inside the other, same tokens.

    Containment is tried for candidates of four letters and more only, so that ``age`` does not
    find ``average_price``.
    """
    cleaned = {}
    for name in names:
        cleaned.setdefault(ascii_header(name), name)
    wanted = [ascii_header(c) for c in candidates if c]

    for want in wanted:
        if want in cleaned:
            return cleaned[want]

    compact = {key.replace("_", ""): name for key, name in cleaned.items()}
    for want in (w.replace("_", "") for w in wanted):
        if want in compact:
            return compact[want]
        if len(want) >= SHORTEST_FUZZY:
            near = [n for key, n in compact.items() if want in key or (len(key) >= SHORTEST_FUZZY and key in want)]
            if near:
                return near[0]

    for candidate in filter(None, candidates):
        tokens = set(re.findall(r"[^\s_\-]+", candidate.lower()))
        if len(candidate) >= SHORTEST_FUZZY:
            for name in names:
                if all(token in name.lower() for token in tokens):
                    return name
    return None


ABSENT = {"absent": True}


def resolved(df: DataFrame, name: str) -> bool:
    """Whether the column stems from the data. One that was only added for the sake of a fixed layout says so in its metadata."""
    return name in df.columns and not df.schema[name].metadata.get("absent", False)


def absent(name: str, kind: str | T.DataType) -> Column:
    """The NULL column that stands for one the data does not have."""
    return F.lit(None).cast(kind).alias(name, metadata=ABSENT)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order; absent ones are NULL, unfit values become NULL."""
    kinds = dict(df.dtypes)

    def fit(field: T.StructField) -> Column:
        if field.name not in kinds:
            return absent(field.name, field.dataType)
        if kinds[field.name] == field.dataType.simpleString():
            value = F.col(field.name)
        else:
            value = F.col(field.name).try_cast(field.dataType)
        return value.alias(field.name)

    return df.select(*map(fit, schema))


def canonical_frame(df: DataFrame, lenient: bool = False) -> DataFrame:
    """The analytics frame: known roles under fixed names, missing ones NULL (``resolved`` tells them), dates derived.

    ``lenient`` is for files with headers of their own: these are brought to plain lower-case names,
    and a role without an exact name is looked for by meaning among the columns that no role has yet.
    """
    if lenient:
        df = with_ascii_headers(df)
    found = {role: pick_first(df.columns, names) for role, names in lx.CANONICAL_NAMES.items()}
    if lenient:
        for role, names in lx.CANONICAL_NAMES.items():
            if found[role] is None:
                found[role] = find_column([c for c in df.columns if c not in found.values()], names)
    if found["order_date"] is None:
        found["order_date"] = next(iter(pick_containing(df.columns, "date")), None)
    if found["order_date"] is None:
        raise ValueError(f"no order date among {df.columns}")
    kinds = dict(df.dtypes)
    chosen = []
    for role, name in found.items():
        if role == "order_date":
            column = F.col(name) if kinds[name] in ("date", "timestamp_ntz") else F.col(name).try_cast("timestamp_ntz")
        elif name is None:
            chosen.append(absent(role, "string"))
            continue
        elif role == "final_amount" and kinds[name] == "string":
            column = F.regexp_replace(name, r"[^0-9.\-]", "").try_cast("decimal(14,4)")
        else:
            column = F.col(name)
        chosen.append(column.alias(role))
    frame = df.select(*chosen)
    derived = {}
    if found["order_year"] is None:
        derived["order_year"] = F.year("order_date")
    if found["order_month"] is None:
        derived["order_month"] = F.month("order_date")
    return frame.withColumns(derived) if derived else frame

"""Run registered queries beside their oracle SQL and report differences.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb

from tradewind.session import build_session, shared_folder

from .oracles import ORACLES
from .registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted(rows):
    def part(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return (0, "")
        return (1, repr(value))
    return sorted((tuple(map(part, row)) for row in rows))


def difference(df, con, sql: str) -> str | None:
    """First difference in columns, types, row count or exact values; None when equal."""
    names = sorted(df.columns)
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({sql})")
    kinds = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    wanted = dict(zip(expected.columns, map(str, expected.types)))
    if kinds != wanted:
        return f"types {[(n, kinds[n], wanted.get(n)) for n in names if kinds[n] != wanted.get(n)]}"
    if len(names) != len(con.sql(sql).columns):
        return f"columns {names} against {con.sql(sql).columns}"
    mine, theirs = _sorted(df.select(*names).collect()), _sorted(expected.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} against {len(theirs)}; only here {list(set(mine) - set(theirs))[:2]}, only there {list(set(theirs) - set(mine))[:2]}"
    if mine != theirs:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(wrong)} of {len(mine)} rows differ: {wrong[0]}"
    return None


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("tradewind-compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="tradewind-compare-"))
    spark.sparkContext.setLogLevel("ERROR")
    shared_folder(spark)
    con, bad = database(folder), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = difference(df, con, ORACLES[name]) if name in ORACLES else f"no oracle, {df.count()} rows"
        except Exception as problem:  # report and go on
            found = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += found is not None and not found.startswith("no oracle")
        print(f"{time.time() - start:6.2f}s {name:26s} {found or 'equal'}", flush=True)
    print(f"{bad} different; without query: {sorted(set(ORACLES) - set(QUERIES))}; without oracle: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

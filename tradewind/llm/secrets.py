"""Secret scans over an incremental ledger of blobs.

Method: every version of every text is addressed by the SHA-256 of its bytes. The ledger is a table
of (blob, rule, version) with what was found; a pair in it is never scanned again. A scan reduces
the texts to distinct blobs, leaves out the pairs that the ledger has, runs the missing rules over
one copy of each remaining blob, appends the findings, and joins them back to all places where the
blob lies.

Defined results: a null text is the empty blob; ties and repeated rows share a blob, which is
scanned once and reported for each row; very long texts are scanned whole; an empty table gives no
rows; only ``doc_id`` and ``text`` are read, so other columns may have any name. Offsets count code
points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import spread_join


class Rule(NamedTuple):
    """A pattern, the group whose length counts, and the least length; a new version scans anew."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


#: The base rules in the order of their kinds.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)


def matcher(rule: Rule):
    """Compiled for scanning: a run of one class is only looked at where it is long enough."""
    pattern = rule.pattern
    if rule.group == 0 and pattern.endswith("]+"):
        # the whole match is a literal and one run of a class, so shorter runs are failing matches
        literal = pattern[: pattern.index("[")]
        pattern = f"{pattern[:-1]}{{{rule.least - len(literal)},}}"
    return re.compile(pattern, re.ASCII)


def spans_of(text: str, rule: Rule, compiled) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _ledger_schema() -> str:
    return "blob string, kind string, version int, starts array<int>, ends array<int>"


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger's findings; an absent ledger is an empty one."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _ledger_schema())
    return spark.read.schema(_ledger_schema()).parquet(ledger)


def addressed(docs: DataFrame) -> DataFrame:
    """(doc_id, blob, text): every version under the address of its content."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.sha2(F.encode(text, "UTF-8"), 256).alias("blob"), text.alias("text"))


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE) -> None:
    """Bring the ledger up to date with all blobs of ``docs`` under the rules' versions."""
    spark = docs.sparkSession
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    blobs = addressed(docs).groupBy("blob").agg(F.first("text").alias("text"))
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    unseen = blobs.join(seen, "blob", "left").select("blob", "text", F.when(F.col("seen").isNull(), wanted).otherwise(F.array_except(wanted, "seen")).alias("rules")).filter(F.size("rules") > 0)
    known = {(r.kind, r.version): r for r in rules}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = {key: matcher(rule) for key, rule in known.items()}
        for batch in batches:
            rows = []
            for blob, text, todo in zip(batch.column("blob").to_pylist(), batch.column("text").to_pylist(), batch.column("rules").to_pylist()):
                for one in todo:
                    key = (one["kind"], one["version"])
                    found = spans_of(text, known[key], compiled[key])
                    rows.append((blob, *key, [a for a, _ in found], [b for _, b in found]))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["blob", "kind", "version", "starts", "ends"])

    unseen.mapInArrow(run, _ledger_schema()).write.mode("append").parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = BASE) -> DataFrame:
    """(doc_id, blob, counts, spans): what the ledger holds under the rules' versions, joined back to every row.

    ``counts`` maps a kind to its number of findings; ``spans`` are structs (start, place of the
    kind, kind, end) in order.
    """
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    held = read_ledger(docs.sparkSession, ledger).filter(F.col("version") == current[F.col("kind")])
    spans = F.transform(F.arrays_zip("starts", "ends"), lambda s: F.struct(s["starts"].alias("start"), place[F.col("kind")].alias("place"), F.col("kind").alias("kind"), s["ends"].alias("end")))
    # a pair that two scans have added stands in the ledger twice, with the same findings
    by_blob = held.groupBy("blob").agg(F.collect_set(F.struct("kind", spans.alias("spans"))).alias("found")).select(
        "blob", F.map_from_entries(F.transform("found", lambda f: F.struct(f["kind"], F.size(f["spans"]).cast("long")))).alias("counts"),
        F.sort_array(F.flatten(F.transform("found", lambda f: f["spans"]))).alias("spans"))
    return spread_join(addressed(docs).drop("text"), by_blob, "blob", ["doc_id"])


def new_ledger(spark) -> str:
    return scratch_path(spark, "secret-ledger")

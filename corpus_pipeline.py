"""The corpus pipeline: quality, near-duplicates, benchmark leaks, source mix and token-id files, in this order.

Every stage takes (spark, docs, sf_dir). What a stage returns is written and read again as the next
one's documents; all but the last return the columns of documents. When a stage begins, the scratch
tables of the stage before it, whose result has been written by then, are deleted.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontam, mixing, output, quality, simhash
from tradewind.llm.common import table
from tradewind.llm.queries import tokenizer
from tradewind.session import drop_stages, scratch_path, stages


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_LEFT: list[str] = []


def stage(work: Stage) -> Stage:
    """The stage, which first deletes what the stage before it left in the shared folder."""
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_stages(spark, _LEFT)
        before = set(stages(spark))
        out = work(spark, docs, sf_dir)
        _LEFT[:] = [path for path in stages(spark) if path not in before]
        return out

    return run_stage


@stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; all labelled rows may teach."""
    labels = table(spark, sf_dir, "labels")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    found, score = quality.scored(docs, known)
    return found.filter(F.col(score) >= quality.LIMIT).select(*docs.columns)


@stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of three-word shingles that differ in two bits at most."""
    return simhash.keep_first(docs, distance=simhash.DISTANCE)


@stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document is there once for each time round that took some of it."""
    return mixing.mixed(docs)


@stage
def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files; of each document in them its id, start, length and checksum."""
    return output.written(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

#: The network, the permutations and the tokenizer have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        path = scratch_path(spark, name)
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Sinks: CSV results, table appends and full reloads, warehouse tables."""

from __future__ import annotations

import json
import os
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import warehouse_schema
from ..session import staged


def write_csv(df: DataFrame, path: str, *partitions: str) -> None:
    """Result table as CSV with a header; blanks around texts are kept."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").partitionBy(*partitions).options(header=True, escape='"', **kept).csv(path)


def append_table(df: DataFrame, name: str) -> None:
    """Rows added to a table of the catalog, columns matched by name; each write is committed whole."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def reload_tables(tables: dict[str, DataFrame], names: dict[str, str] | None = None) -> None:
    """Replace the rows of catalog tables, in the given order.

    All new rows are computed and staged before any table is touched, so a failure on the way leaves
    every table as it was. Each table is then replaced by one committed overwrite. Readers that must see all tables
    change at once use ``publish``.
    """
    named = {table: (names or {}).get(table, table) for table in tables}
    held = {table: staged(df.select(*df.sparkSession.table(named[table]).columns), "reload") for table, df in tables.items()}
    for table, df in held.items():
        df.write.insertInto(named[table], overwrite=True)


#: Names of the file that tells a folder's current version, and of the folder of versions.
MANIFEST, VERSIONS = "manifest.json", "versions"


def publish(spark: SparkSession, tables: dict[str, DataFrame], folder: str, partitions: dict[str, str] | None = None, rebalanced: bool = True) -> str:
    """Write all tables as a new version below the folder, then make it the current one; the version's name.

    Readers find tables through the manifest, which one rename replaces, so they see all tables of the old version or all
    of the new one. A failure before that leaves the old version current. Versions stay until ``drop_versions``.
    """
    version = f"{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}-{os.urandom(4).hex()}"
    for name, df in tables.items():
        write_table(df, f"{folder}/{VERSIONS}/{version}/{name}", (partitions or {}).get(name), rebalanced=rebalanced)
    schemas = {name: df.schema.jsonValue() for name, df in tables.items()}
    replace_file(spark, f"{folder}/{MANIFEST}", json.dumps({"version": version, "tables": schemas}))
    return version


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file written beside its place and renamed over it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target, aside = hadoop.Path(path), hadoop.Path(f"{path}.{os.urandom(4).hex()}")
    out = aside.getFileSystem(conf).create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = target.getFileSystem(conf)
    whole = [p.makeQualified(files.getUri(), files.getWorkingDirectory()) for p in (aside, target)]
    hadoop.FileContext.getFileContext(files.getUri(), conf).rename(*whole, options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, if it is there."""
    try:
        return spark.read.option("wholetext", True).text(path).first()[0]
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def manifest(spark: SparkSession, folder: str) -> dict:
    """The folder's current version and its tables with their schemas."""
    text = read_file(spark, f"{folder}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return json.loads(text)


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the current version."""
    current = manifest(spark, folder)
    schemas = {name: T.StructType.fromJson(schema) for name, schema in current["tables"].items()}
    return {name: spark.read.schema(schema).parquet(f"{folder}/{VERSIONS}/{current['version']}/{name}").select(*schema.names) for name, schema in schemas.items()}


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete all versions but the newest ``keep`` and the current one; the names of those deleted."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    place = hadoop.Path(f"{folder}/{VERSIONS}")
    files = place.getFileSystem(conf)
    held = sorted(status.getPath().getName() for status in files.listStatus(place))
    gone = [v for v in held[: max(len(held) - keep, 0)] if v != manifest(spark, folder)["version"]]
    for version in gone:
        files.delete(hadoop.Path(f"{folder}/{VERSIONS}/{version}"), True)
    return gone


def export_rejects(rejects: DataFrame, path: str) -> None:
    """All rejected texts for reviewers, as CSV in one folder per rule."""
    write_csv(rejects, path, "rule")


def append_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    df.write.mode("append").option("batchsize", batch).options(**options).format("jdbc").option("url", url).option(
        "dbtable", table).save()


def reload_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, **options: str) -> None:
    """Empty the table, keep its definition, load again."""
    df.write.mode("overwrite").option("truncate", True).option("batchsize", batch).options(**options).format(
        "jdbc").option("url", url).option("dbtable", table).save()


def create_table(spark: SparkSession, table: str, name: str | None = None, path: str | None = None) -> None:
    """Empty warehouse table in the catalog; the fact is partitioned by order year."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in warehouse_schema(table)
    )
    partition = " PARTITIONED BY (order_year)" if table == "transactions" else ""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name or table} ({columns}) USING parquet{partition}{location}")


def write_table(df: DataFrame, path: str, partition: str | None = None, mode: str = "overwrite", rebalanced: bool = True) -> None:
    """Parquet table. A partitioned one is rebalanced first, so that no year makes one huge file or
    thousands of small ones; adaptive execution splits the years that are too large. Where tasks of even size
    hold few values each, that exchange of all rows can be left out."""
    if partition:
        (df.hint("rebalance", F.col(partition)) if rebalanced else df).write.mode(mode).partitionBy(partition).parquet(path)
    else:
        df.write.mode(mode).parquet(path)

"""Scans: raw and typed CSV, tables with projection, presence guards."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import null_tokens

SEQUENCE = "_seq"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names, from the header line alone."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


#: Files whose first lines are read at a time.
_AT_ONCE = 16


def _first_line(spark: SparkSession, path: str) -> str:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    source = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(source) if codec else source, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return (line or "").removeprefix("\ufeff")
    finally:
        source.close()


def header_groups(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for each distinct header line among the files of a path; only first lines are read."""
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: _first_line(spark, file), files))
    groups: dict[str, list[str]] = {}
    for header, file in zip(headers, files):
        groups.setdefault(header, []).append(file)
    return [(csv_header(spark, own[0]), own) for header, own in groups.items() if header]


BROKEN = "_broken_record"
#: Characters of the longest record whose quoted texts hold line breaks. A quote that is never closed would run on to the end of its file.
LONGEST_RECORD = 1 << 24
#: No text holds this character; it keeps a line in one piece.
_NO_SEPARATOR = "\uffff"


def _place(row: Column) -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block_start"), row.alias("row")).alias(SEQUENCE)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(value, place): every line of the files but the header, which is the first line of each file and no other."""
    options = {"header": True, "sep": _NO_SEPARATOR, "quote": "", "escape": "", "enforceSchema": True}
    lines = spark.read.schema("value STRING").options(**options).csv(files)
    return lines.select("value", _place(F.monotonically_increasing_id())).filter(F.trim("value") != "")


def joined_lines(lines: DataFrame, longest: int = LONGEST_RECORD) -> DataFrame:
    """(value, place, header) of every record of ``lines(value, _seq)``, whose quoted texts may hold line breaks.

    Lines come in blocks, as Spark splits the files. Each block tells how many of its lines have an odd
    number of quotes, and which was the last. Added up over a file's blocks this tells whether a block begins inside a quoted
    text, and where the record that it continues began. So every line knows from its own block alone whether it is a
    record, begins one or continues one. Only lines of records that have several are brought together. Lines are exchanged
    once, by their block.
    """
    file, block, row = (F.col(f"{SEQUENCE}.{part}") for part in ("file_path", "file_block_start", "row"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    told = lines.select("value", file.alias("_file"), block.alias("_block"), row.alias("_row"), odd.cast("int").alias("_odd"))
    blocks = told.groupBy("_file", "_block").agg(F.sum("_odd").alias("_odds"), F.max(F.when(F.col("_odd") == 1, F.struct("_block", "_row"))).alias("_last"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.select("_file", "_block", F.coalesce(F.sum("_odds").over(earlier), F.lit(0)).alias("_before"), F.max("_last").over(earlier).alias("_carried"))
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = told.select("*", F.row_number().over(inside).alias("_n"), F.coalesce(F.sum("_odd").over(above), F.lit(0)).alias("_above"),
                         F.max(F.when(F.col("_odd") == 1, F.struct("_block", "_row"))).over(above).alias("_opened"))
    met = placed.join(begun, ["_file", "_block"]).withColumn("_open", (F.col("_before") + F.col("_above")) % 2 == 1)
    own = F.struct("_block", "_row")
    starts = F.when(F.col("_open"), F.coalesce("_opened", "_carried")).otherwise(own)
    known = met.withColumn("_start", starts).withColumn("_header", (F.col("_block") == 0) & (F.col("_n") == 1))

    def place(start: str) -> Column:
        return F.struct(F.col("_file").alias("file_path"), F.col(f"{start}._block").alias("file_block_start"), F.col(f"{start}._row").alias("row")).alias(SEQUENCE)

    alone = known.filter(~F.col("_open") & (F.col("_odd") == 0)).select("value", place("_start"), "_header")
    parts = known.filter(F.col("_open") | (F.col("_odd") == 1))
    sizes = parts.groupBy("_file", "_start").agg(F.sum(F.length("value") + 1).alias("_size"))
    sized = parts.join(sizes, ["_file", "_start"])
    whole = sized.filter(F.col("_size") <= longest).groupBy("_file", "_start").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_row", "value"))), lambda x: x["value"]), "\n").alias("value"), F.max("_header").alias("_header"))
    endless = sized.filter(F.col("_size") > longest).withColumn("_start", own)  # its lines are told one by one
    return alone.unionByName(whole.select("value", place("_start"), "_header")).unionByName(endless.select("value", place("_start"), "_header"))


def _raw_csv(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """Every column as text, the record itself where it is broken, and the record's place in the input.

    Files are read by their own headers: one scan for each distinct header, columns matched by name.
    """
    return union_chunks([_raw_group(spark, names, files, multiline) for names, files in header_groups(spark, path)])


def _raw_group(spark: SparkSession, names: list[str], files: list[str], multiline: bool) -> DataFrame:
    layout = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in [*names, BROKEN])
    options = {"escape": '"', "columnNameOfCorruptRecord": BROKEN, "multiLine": str(multiline).lower()}
    if multiline:
        lines = spark.read.option("lineSep", "\n").text(files).select("value", _place(F.monotonically_increasing_id()))
        ended = F.regexp_replace("value", "\r$", "").alias("value")
        records = joined_lines(lines).filter(~F.col("_header") & (F.trim("value") != "")).select(ended, SEQUENCE).filter(F.col("value") != "")
    else:
        records = _lines(spark, files)
    open_quote = F.length("value") % 2 != F.length(F.replace("value", F.lit('"'), F.lit(""))) % 2
    parsed = records.withColumn("_record", F.from_csv("value", layout, options)).withColumn("_open", open_quote)
    columns = [F.col("_record").getField(name).alias(name) for name in names]
    broken = F.when(F.col("_open"), F.col("value")).otherwise(F.col("_record").getField(BROKEN))
    return parsed.select(*columns, broken.alias(BROKEN), SEQUENCE)


def broken_records(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Records with an unclosed quote or with too few or too many columns, such as the parts of one with a line break in quotes."""
    raw = _raw_csv(spark, path, multiline)
    # Spark refuses a scan of the broken records alone, so another column is looked at as well
    broken = raw.filter(F.col(BROKEN).isNotNull() & (F.length(F.coalesce(F.col(f"`{raw.columns[0]}`"), F.lit(""))) >= 0))
    return broken.groupBy(F.lit("record").alias("rule"), F.col(BROKEN).alias("raw")).agg(F.count(F.lit(1)).alias("rows"))


def scan_text(spark: SparkSession, path: str, sequence: bool = False, multiline: bool = False) -> DataFrame:
    """CSV with every column as text and the usual missing-value tokens as NULL; a file or a folder of them.

    Files of a folder may differ in their headers; columns are matched by name, and a column that a
    file lacks is NULL there. Files whose quoted texts hold line breaks need ``multiline``, which
    costs an exchange of the lines (``joined_lines``). Otherwise the parts of such records are left out here and
    listed by ``broken_records``; no part of one reaches another column.

    Files are split by Spark in both modes, so a large file needs no chunk loop. With ``sequence`` the place of
    each row in the input is kept as a sortable column (file, block, row in block), which does not
    depend on how splits are packed into tasks.
    """
    raw = _raw_csv(spark, path, multiline).filter(F.col(BROKEN).isNull())
    columns = [null_tokens(F.col(f"`{name}`")).alias(name) for name in raw.columns if name not in (BROKEN, SEQUENCE)]
    return raw.select(*columns, *([SEQUENCE] if sequence else []))


def scan_typed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", multiline: bool = False) -> DataFrame:
    """Cleaned table with a declared schema; no inference pass."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def union_chunks(chunks: list[DataFrame]) -> DataFrame:
    """All chunks as one table, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def try_scan(scan, *args, required: bool = True, **kwargs) -> DataFrame | None:
    """Run a scan; a missing path is an error, or ``None`` when the input is optional."""
    try:
        return scan(*args, **kwargs)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        if required:
            raise FileNotFoundError(str(problem).splitlines()[0]) from problem
        return None


def table_columns(spark: SparkSession, table: str) -> dict[str, str]:
    """Column catalog of a table: name -> type."""
    return {c.name: c.dataType for c in spark.catalog.listColumns(table)}


def scan_jdbc(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """Database table read in parallel ranges of a numeric key."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low,
                                               upperBound=high, numPartitions=parts)
    return reader.options(**options).load()


def first_rows(df: DataFrame, count: int, *order) -> DataFrame:
    """The first ``count`` rows in a stated order."""
    return df.orderBy(*order).limit(count)


def sample_by_hash(df: DataFrame, key: str, count: int) -> DataFrame:
    """A repeatable random sample of ``count`` rows: the smallest hashes of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(count)

"""Line dedup by winnowing: repeated runs of lines go, wherever they first stood stays.

Method: a text is cut into lines, and the lines are hashed. Long lines are cut where their words say so,
not at counted places: a piece ends with the first word after ``LEAST`` - 1 others whose last character
is one of ``ENDS``, at ``MOST`` words if there is none. So a passage is cut alike wherever it stands in a
line, but for the words before the first place where both cuts meet. Of
every ``RUN`` lines in a row the one with the smallest hash (of equal ones the last) is a
fingerprint, so any two equal runs of ``RUN`` lines are guaranteed to share one at the same place.
Fingerprints that occur once in the corpus are dropped. Around each of the others the match is
extended both ways: every run of ``RUN`` lines whose minimum it is, told by 128 bits of its lines' hashes,
is joined with the earliest place where the same run stands. Runs that do not overlap that place are
later copies; adjoining copies merge to runs of any length, and these are deleted. All of it is
DataFrame functions; fingerprints and runs are found on hashes only, and only texts that lose lines
are exchanged.

Defined results: "earlier" goes by doc_id (null last), then by the row, then by the place in the
text, so of repeated rows one keeps its text; a null text stays null, an empty one empty, both with
no lines; texts of fewer than ``RUN`` lines keep all; white space at a line's end does not tell lines
apart; texts of any length are deduplicated whole; an empty table gives no rows; further columns,
whatever their names, pass unchanged. Words that end in letters of other scripts end no piece, so
lines without ``ENDS`` are cut at every ``MOST`` words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.patching import BITS_A_ROW, MOST_BITS, key_bits, patch
from ..session import staged
from .common import SLOTS, fresh, spread_join, stored

RUN = 3
#: A run that holds more than one of so many parts of all places is dealt into slots.
SHARES = 20_000
#: Words of a piece of a long line, and the characters of which one ends the last of them: signs and vowels.
LEAST, MOST = 4, 16
ENDS = ".,;:!?aeiouy"
#: A line: some words, then words that end no piece and one more; else up to MOST words; or white space alone.
LINE = (r"(?:\S++[ \t\x0B\f\r]++){%d}+(?:\S++(?<![%s])[ \t\x0B\f\r]++){0,%d}+(?:\S++(?:[ \t\x0B\f\r]++|(?=\n)|\z))?+\n*+"
        r"|(?:\S++[ \t\x0B\f\r]*+){1,%d}+\n*+|\s++")
_WHITE = "\\u0020\\u0009\\u000A\\u000B\\u000C\\u000D"


def lines_of(text: Column) -> Column:
    """The text's lines; joined they are the text again."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(LINE % (LEAST - 1, ENDS, MOST - LEAST, MOST)), F.lit(0))


def _hashes(lines: str) -> Column:
    return F.expr(f"transform({lines}, x -> xxhash64(rtrim('{_WHITE}', x)))")


def _surroundings(hashes: str, run: int) -> Column:
    """For each place an array element with the hashes of the lines around it, NULL beyond the text: fields ``0`` to ``2 * run - 2``, its own in the middle."""
    edge = f"array({', '.join(['cast(null as bigint)'] * (run - 1))})"
    padded = f"concat({edge}, {hashes}, {edge})" if run > 1 else hashes
    return F.expr(f"arrays_zip({', '.join(f'slice({padded}, {k + 1}, size({hashes}))' for k in range(2 * run - 1))})")


def _is_minimum(around: str, run: int) -> list[Column]:
    """For each run that holds the place, the earliest first: is the place the last of the smallest in it? NULL for a run beyond the text."""
    own = F.col(around)[str(run - 1)]
    out = []
    for j in range(run):
        tests = [own <= F.col(around)[str(k)] for k in range(j, run - 1)] + [own < F.col(around)[str(k)] for k in range(run, j + run)]
        out.append(reduce(lambda a, b: a & b, tests, F.lit(True)))
    return out


def among(rows: DataFrame, key: str, few: DataFrame, spread_by: list[str], most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose key is one of ``few(key)``, and perhaps some others.

    A bit map of the keys is broadcast, 64 MB at most, and lets one in sixteen of the other rows by;
    nothing is exchanged. More keys than it has room for are met by a join in slots.
    """
    few = staged(few, "few")
    wanted, bits = BITS_A_ROW * few.count(), 1 << 15
    if wanted > most_bits:
        (hit,) = fresh(rows, "hit")
        return spread_join(rows, few.withColumn(hit, F.lit(True)), key, spread_by).filter(hit).drop(hit)
    while bits < wanted:
        bits *= 2
    marked = staged(key_bits(few, [key], bits), "few-bits")
    met = rows.withColumn("_at", F.pmod(F.xxhash64(key), F.lit(bits))).join(F.broadcast(marked), F.expr("_at div 32768") == F.col("_bucket"))
    return met.filter("shiftright(_words[cast(_at div 64 % 512 as int)], cast(_at % 64 as int)) & 1L = 1L").select(*rows.columns)


def repeated_runs(hashed: DataFrame, run: int = RUN, most_bits: int = MOST_BITS) -> DataFrame:
    """(row, starts) of ``hashed(doc_id, row, h)``: the sorted starts of runs that are later copies."""
    minima = _is_minimum("around", run)
    places = hashed.select("doc_id", "row", F.posexplode(_surroundings("h", run)).alias("p", "around")).filter(reduce(lambda a, b: a | b, minima))
    fingerprints = places.withColumn("value", F.col("around")[str(run - 1)])
    shared = fingerprints.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("value")
    # all runs whose minimum the fingerprint is
    inside = [[F.col("around")[str(k)] for k in range(j, j + run)] for j in range(run)]
    runs = [F.when(minima[j], F.struct((F.col("p") + (j - run + 1)).alias("s"), F.struct(F.xxhash64(*inside[j]).alias("one"), F.xxhash64(F.lit(1), *inside[j]).alias("two")).alias("content"))) for j in range(run)]
    windows = among(fingerprints, "value", shared, ["row", "p"], most_bits).select("doc_id", "row", F.explode(F.array(*runs)).alias("run")).filter("run is not null")
    windows = staged(windows.select("doc_id", "row", "run.*"), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.col("row"), F.col("s"))
    earliest = staged(windows.groupBy("content").agg(F.min(place).alias("source"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "earliest")
    repeated = among(windows, "content", earliest.select("content"), ["row", "s"], most_bits)
    # a run with more than its share of all places is dealt into slots; so there are SHARES of them at most
    total = windows.count()
    hot = F.col("n") * SHARES > total
    often = earliest.filter(hot).select("content", F.lit(SLOTS).alias("slots"))
    dealt = repeated.join(F.broadcast(often), "content", "left").withColumn("slot", F.coalesce(F.pmod(F.xxhash64("row", "s"), "slots"), F.lit(0)).cast("int"))
    copied = earliest.withColumn("slot", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0)))))
    found = dealt.join(copied, ["content", "slot"]).withColumn("place", place)
    copies = found.filter((F.col("place") > F.col("source")) & ((F.col("row") != F.col("source.row")) | (F.col("s") >= F.col("source.s") + run)))
    return copies.groupBy("row").agg(F.sort_array(F.collect_set("s")).alias("starts"))


def _kept(starts: str, run: int) -> dict[str, Column]:
    """Borders of the deleted parts."""
    begins = F.expr(f"filter({starts}, (x, i) -> i = 0 or x > {starts}[i - 1] + {run})")
    ends = F.expr(f"transform(filter({starts}, (x, i) -> i = size({starts}) - 1 or {starts}[i + 1] > x + {run}), x -> x + {run})")
    return {"begins": begins, "ends": ends}


def deduplicated(docs: DataFrame, run: int = RUN, most_bits: int = MOST_BITS) -> tuple[DataFrame, str, str]:
    """(all columns, ``text`` without repeated runs, and two more: lines and deleted lines; their names)."""
    n_lines, n_deleted = fresh(docs, "n_lines", "n_deleted")
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("whole")
    marked = docs.select(F.monotonically_increasing_id().alias("row"), whole, lines_of(F.col("text")).alias("lines"))
    marked = marked.withColumn("h", _hashes("lines")).drop("lines")
    hashed = stored(marked, "hashed-lines")
    repeated = repeated_runs(hashed.select(F.col("whole.doc_id").alias("doc_id"), "row", "h"), run, most_bits)
    counted = hashed.select("row", "whole", F.size("h").cast("long").alias("n_lines"))
    met = patch(repeated, ["row"], ["starts"]).put(counted, small_rows=0)
    # only a text that loses lines is cut again
    met = met.withColumn("lines", F.when(F.col("starts").isNotNull(), lines_of(F.col("whole.text")))).withColumns(_kept("starts", run))
    parts = F.expr("transform(sequence(0, size(begins)), k -> array_join(slice(lines, if(k = 0, 0, ends[k - 1]) + 1, if(k = size(begins), size(lines), begins[k]) - if(k = 0, 0, ends[k - 1])), ''))")
    gone = F.expr("aggregate(zip_with(ends, begins, (e, b) -> e - b), 0, (a, x) -> a + x)")
    text = F.when(F.col("starts").isNull(), F.col("whole.text")).otherwise(F.array_join(parts, ""))
    deleted = F.when(F.col("starts").isNull(), F.lit(0)).otherwise(gone).cast("long")
    kept = [text.alias(c) if c.lower() == "text" else F.col("whole")[c].alias(c) for c in docs.columns]
    return met.select(*kept, F.col("n_lines").alias(n_lines), deleted.alias(n_deleted)), n_lines, n_deleted


ORACLE = r"""
WITH lined AS (
    SELECT doc_id, i, line, rtrim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content
    FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]+){3,15}?[^\x20\x09-\x0D]*[.,;:!?aeiouy](?:[\x20\x09\x0B-\x0D]+\n*|\n+|\z)|(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,16}\n*|[\x20\x09-\x0D]+') AS lines FROM documents WHERE text IS NOT NULL))
), runs AS (
    SELECT doc_id, i AS s, content AS a, lead(content, 1) OVER w AS b, lead(content, 2) OVER w AS c
    FROM lined WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), copies AS (
    SELECT doc_id, s FROM (
        SELECT doc_id, s, first_value(doc_id) OVER p AS d0, first_value(s) OVER p AS s0 FROM runs WHERE b IS NOT NULL AND c IS NOT NULL
        WINDOW p AS (PARTITION BY a, b, c ORDER BY doc_id, s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE (doc_id <> d0) OR (s >= s0 + 3)
), gone AS (
    SELECT DISTINCT doc_id, s + k AS i FROM copies, (SELECT unnest([0, 1, 2]) AS k)
), told AS (
    SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS deleted FROM lined l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
), texts AS (
    SELECT doc_id, coalesce(string_agg(CASE WHEN NOT deleted THEN line END, '' ORDER BY i), '') AS text, count(*) AS n_lines, count(*) FILTER (WHERE deleted) AS n_deleted
    FROM told GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text,
       CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.n_deleted, 0) AS BIGINT) AS n_deleted
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""

import random
import re

import pytest

from checks.compare import database, difference
from tradewind.llm import lines
from tradewind.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapIn|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin")


def units_of(text):
    """Lines by hand: a piece ends at a line's end, at the fourth word or a later one that ends in a sign or a vowel, or at the sixteenth."""
    found = [m.span() for m in WORD.finditer(text)]
    if not found:
        return [text] if text else []
    held = 0
    cuts = [found[0][0]] if found[0][0] else []
    for k, (a, z) in enumerate(found):
        held += 1
        after = found[k + 1][0] if k + 1 < len(found) else len(text)
        gap = text[z:after]
        broken = "\n" in gap
        if broken or held == 16 or held >= 4 and text[z - 1] in ".,;:!?aeiouy" or after == len(text):
            held = 0
            last = z + len(gap) if not broken else z + gap.index("\n") + len(gap[gap.index("\n"):]) - len(gap[gap.index("\n"):].lstrip("\n"))
            cuts.append(last)
            if last < after:
                cuts.append(after)  # white space alone after the line breaks
    return [text[a:z] for a, z in zip([0, *cuts], cuts)]


def plain(texts, run=3):
    """Texts in order; a run of lines that stood before, not overlapping, is deleted."""
    first, out = {}, []
    cut = [units_of(t or "") for t in texts]
    for d, units in enumerate(cut):
        content = [u.rstrip(" \t\n\x0b\x0c\r") for u in units]
        gone = set()
        for s in range(len(units) - run + 1):
            key = tuple(content[s:s + run])
            where = first.setdefault(key, (d, s))
            if where[0] != d or s >= where[1] + run:
                gone |= set(range(s, s + run))
        out.append((None if texts[d] is None else "".join(u for i, u in enumerate(units) if i not in gone), len(units), len(gone)))
    return out


@pytest.mark.parametrize("most_bits", [lines.MOST_BITS, 0])
def test_equals_plain_version_on_edges(spark, edges, most_bits):
    rows = [(i, f"{i % 7}\n{i % 3}\n{i % 5}\nx\ny{i}\n" * (i % 4)) for i in range(60)]
    rows += [(60 + i, f"w v{i % 2} x \nu v \x0b\n\n o p q r\r\ns t a, {i % 2} b \n  \n c") for i in range(6)]
    docs = edges.select("doc_id", "text", "row", "lines").filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(
        spark.createDataFrame([(100 + i, t, None, "z") for i, t in rows], "doc_id long, text string, row string, lines string"))
    ordered = sorted(docs.collect(), key=lambda r: r["doc_id"])
    found, n_lines, n_deleted = lines.deduplicated(docs, most_bits=most_bits)
    got = {r["doc_id"]: (r["text"], r[n_lines], r[n_deleted], r["lines"]) for r in found.collect()}
    for r, expected in zip(ordered, plain([r["text"] for r in ordered])):
        assert got[r["doc_id"]] == (*expected, r["lines"])
    assert found.columns[:4] == docs.columns


def test_repeated_rows_keep_one_text(spark, edges, nothing):
    text = "\n".join(f"line {i}" for i in range(9))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (None, None)], "doc_id long, text string")
    found, _, n_deleted = lines.deduplicated(docs)
    rows = found.collect()
    assert sorted(r[n_deleted] for r in rows) == [0, 0, 9, 9] and [r["text"] for r in rows if r["doc_id"] == 5 and r[n_deleted] == 0] == [text]
    assert lines.deduplicated(nothing)[0].count() == 0
    assert lines.deduplicated(edges)[0].count() == edges.count()


def test_a_hot_line_and_native_plan(spark):
    docs = spark.createDataFrame([(i, f"common line\nown {i}\ncommon line\nown too {i}") for i in range(3000)], "doc_id long, text string").repartition(4)
    found, _, n_deleted = lines.deduplicated(docs)
    assert found.filter(f"{n_deleted} > 0").count() == 0 and found.count() == 3000
    assert not PYTHON.search(found._jdf.queryExecution().executedPlan().toString())


def test_query_equals_sql(spark, sf_dir):
    assert difference(QUERIES["op2_line_dedup"](spark, sf_dir), database(sf_dir), ORACLES["op2_line_dedup"]) is None


def test_a_passage_is_found_at_any_offset(spark):
    rng = random.Random(4)
    words = "the river of stone and a letter in morning light by windows that held quiet harbour lanterns over two meadows".split()

    def some(n):
        return [rng.choice(words) + str(rng.randrange(900)) * (rng.random() < 0.2) + rng.choice(["", "", "", ",", "."]) for _ in range(n)]

    passage = some(135)
    rows = [(k, " ".join([*some(at), *passage, *some(30)])) for k, at in enumerate([185, 158, 160, 3, 176])]
    found, _, n_deleted = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {r["doc_id"]: len(WORD.findall(r["text"])) for r in found.collect()}
    assert left[0] == 350
    for k, text in rows[1:]:
        assert len(text.split()) - left[k] >= 115


def later_passages(texts, length=50):
    """(text number, first word, end): words of maximal passages of which every ``length`` words in a row stood before."""
    first, out = {}, []
    for d, text in enumerate(texts):
        words = WORD.findall(text)
        for i in range(len(words) - length + 1):
            where = first.setdefault(tuple(words[i:i + length]), (d, i))
            if where[0] != d or i >= where[1] + length:
                if out and out[-1][0] == d and i <= out[-1][2]:
                    out[-1] = (d, out[-1][1], i + length)
                else:
                    out.append((d, i, i + length))
    return out


def test_repeats_of_fifty_words_against_brute_force_on_words(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id is not null").select("doc_id", "text").orderBy("doc_id").collect()
    found, _, n_deleted = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    deleted = {r["doc_id"]: r[n_deleted] for r in found.collect()}
    left = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in found.collect()}
    repeats = later_passages([r["text"] or "" for r in rows])
    assert len(repeats) > 50
    caught = sum(deleted[rows[d]["doc_id"]] > 0 for d, _, _ in repeats)
    words = sum(z - a for _, a, z in repeats)
    assert caught >= 0.95 * len(repeats)
    assert sum(len(WORD.findall(r["text"] or "")) - left[r["doc_id"]] for r in rows) >= 0.85 * words

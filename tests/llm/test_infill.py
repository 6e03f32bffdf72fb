import hashlib
import re

from pyspark.sql import functions as F

from checks.compare import database, difference
from tradewind.llm import infill
from tradewind.llm.queries import ORACLES, QUERIES


def plain(doc_id, text, seed=1, rate=90, first=20):
    """The same by slicing a list of units."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted([h1 % (len(units) + 1), h2 % (len(units) + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", text, None, None
    if h4 % 100 < first:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def check(docs, **options):
    made, names = infill.infilled(docs, **options)
    n, form, output, *_ = names
    found = made.withColumn("back", infill.restored(F.col(output), F.col(form))).collect()
    for r in found:
        assert tuple(r[x] for x in names) == plain(r["doc_id"], r["text"], *options.values())
        assert r["back"] == (r["text"] or "")
    return found


def test_edges(spark, edges, nothing):
    clashing = edges.withColumnRenamed("vector", "N").withColumnRenamed("blob", "output").withColumnRenamed("slot", "a")
    made, names = infill.infilled(clashing)
    assert made.columns == [*clashing.columns, *names] and names == ["_n", "form", "_output", "prefix_chars", "middle_chars"]
    assert len(check(clashing)) == edges.count()
    assert infill.infilled(nothing)[0].count() == 0


def test_markers_breaks_and_signs_of_patterns(spark):
    texts = ["<P>", "a <S> b", "x<M>", "<p>", "<", ">S><", "P><S", "<P <S <M", "$1 \\ {2} (?s) \\Q [a] ^$", "line\nline\r\nline x\x85y", "😀😀a😀", "éé", "a", " ", "\x00\x01", "日本語abc한글"]
    rows = [(i, t) for i, t in enumerate(texts * 40)]
    found = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    check(spark.createDataFrame(rows[:200], "doc_id long, text string"), seed=7, rate=100, suffix_first=50)


def test_very_long_texts(spark):
    texts = [". " * 600_000, "word " * 200_000, "x" * 3_000_000, "\n" * 700_000, "ab1" * 500_000, "😀" * 400_000]
    check(spark.createDataFrame([(i + 10 * k, t) for k in range(3) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6))


def test_query(spark, sf_dir):
    df = QUERIES["op12_infill"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and plan.count("RegExpExtractAll") + plan.count("regexp_extract_all") == 1
    assert difference(df, database(sf_dir), ORACLES["op12_infill"]) is None

import re

import numpy as np
import pytest

from tradewind.llm import mixing
from tradewind.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_by_hand():
    assert mixing.targets([100, 100, 100]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    sizes = [5, 1000, 0, 40, 3, 3, 700]
    wanted = mixing.targets(sizes)
    assert sum(wanted) == pytest.approx(1.5 * sum(sizes)) and all(w <= 2 * s for w, s in zip(wanted, sizes))


def test_draws_keep_their_totals():
    quotas = [1000, 0, 7, 333, 2]
    out = mixing.draws(quotas, 16, 5)
    assert out.sum(axis=0).tolist() == quotas and (out >= 0).all() and np.ptp(out.sum(axis=1)) <= 1
    assert (out == mixing.draws(quotas, 16, 5)).all() and (out != mixing.draws(quotas, 16, 6)).any()


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(size):
    out = mixing.permuted(np.arange(size), size, 77)
    assert sorted(out.tolist()) == list(range(size))
    if size > 60:
        assert (out != mixing.permuted(np.arange(size), size, 78)).any() and (out != np.arange(size)).any()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op7_mixing"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text").toPandas()
    met = rows.merge(docs, on="doc_id")
    assert (met["size"] == [len(WORD.findall(t or "")) for t in met["text"]]).all() and len(rows) == len(docs)
    by_source = met.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by_source["size"] == by_source["source_size"]).all()
    assert by_source["target"].tolist() == pytest.approx(mixing.targets(by_source["size"].tolist()))
    assert (abs(by_source["taken"] / by_source["target"] - 1) < 0.02).all() and (rows["taken"] <= 2 * rows["size"]).all()
    again = QUERIES["op7_mixing"](spark, folder).toPandas()
    assert again.sort_values("doc_id").reset_index(drop=True).equals(rows.sort_values("doc_id").reset_index(drop=True))


def test_taken_equals_a_plain_layout(spark, edges):
    """Lay the blocks out by hand from the plan's slots and count words."""
    sizes = mixing._sizes(edges)
    rows = mixing.mixture(edges, block=16, shards=4).collect()
    assert len(rows) == edges.count() and all(r["taken"] <= 2 * r["size"] for r in rows) and all(r["taken"] == 0 for r in rows if not r["size"])
    marked, totals = mixing._laid_out(sizes)
    per_source, ranges, slots = mixing._plan(totals, mixing.WEIGHTS, mixing.SHARE, mixing.MOST_TIMES, 16, 4, mixing.SEED)
    times = {}
    for s in mixing._slots(ranges, mixing.SEED, 2).collect():
        times[s["key"], s["block"]] = times.get((s["key"], s["block"]), 0) + 1
    assert sum(times.values()) == slots
    low = lambda v: (v is not None, v or 0)
    layout = sorted(marked.collect(), key=lambda r: (r["key"], r["bucket"], low(r["doc_id"]), r["size"], r["tie"]))
    expected, start = [], {}
    for r in layout:
        first = start.get(r["key"], 0)
        start[r["key"]] = first + r["size"]
        expected.append((r["doc_id"], r["size"], sum(times.get((r["key"], w // 16), 0) for w in range(first, first + r["size"]))))
    assert sorted(expected, key=str) == sorted(((r["doc_id"], r["size"], r["taken"]) for r in rows), key=str)


def test_mixed_documents_hold_the_words_taken(spark, edges, nothing):
    taken = {}
    for r in mixing.mixture(edges.filter("doc_id is not null").dropDuplicates(["doc_id"]), block=16).collect():
        taken[r["doc_id"]] = r["taken"]
    docs = edges.filter("doc_id is not null").dropDuplicates(["doc_id"])
    found = mixing.mixed(docs, block=16)
    assert found.columns == docs.columns
    words, texts = {}, {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
        assert set(WORD.findall(r["text"])) <= set(WORD.findall(texts[r["doc_id"]])) and r["n_chars"] == len(r["text"])
    assert words == {i: n for i, n in taken.items() if n}
    assert mixing.mixed(edges).count() > 0 and mixing.mixture(nothing).count() == 0 and mixing.mixed(nothing).count() == 0

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tradewind.llm import simhash
from tradewind.llm.queries import QUERIES


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, distance=2):
    """Smallest index that each can reach."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(prints))]


def test_fingerprints_by_the_definition(edges):
    texts = [r["text"] for r in edges.collect() if len(r["text"] or "") < 20_000]
    assert [int(x) & (1 << 64) - 1 for x in simhash.fingerprints_of([(t or "").encode() for t in texts])] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("distance, members", [(2, 4096), (2, 3), (4, 20)])
def test_links_join_what_brute_force_joins(spark, distance, members):
    rng = np.random.default_rng(4)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 150, dtype=np.uint64)] + [0, (1 << 64) - 1]
    for _ in range(400):  # chains and clusters
        prints.append(prints[rng.integers(len(prints))] ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))))
    prints = sorted(set(prints))
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)), i) for i, p in enumerate(prints)], "fp long, own long")
    found = {r["fp"] & (1 << 64) - 1: r["first"] for r in simhash.groups(df, F.col("own"), members, distance).collect()}
    assert [found[p] for p in prints] == roots(prints, distance)


def test_query(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    prints = [int(x) & (1 << 64) - 1 for x in simhash.fingerprints_of([(r["text"] or "").encode() for r in docs])]
    expected = {docs[i]["doc_id"]: (f"{prints[i]:016x}", docs[root]["doc_id"]) for i, root in enumerate(roots(prints))}
    rows = QUERIES["op9_simhash"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == expected and len(rows) == len(docs)


def test_edges(spark, edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    group = {}
    for r in rows:
        group.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert len(rows) == edges.count() and group[1] == group[2] == group[3] == {1} and group[4] == group[5] == group[6] == {4}
    assert group[9] == group[10] == {9} and group[12] == {12}
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_first(nothing).count() == 0
    kept = simhash.keep_first(edges)
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert kept.columns == edges.columns and len(ids) == len(set(ids))
    assert {i for unnamed, i, _ in ids if not unnamed} == {1, 4, 7, 8, 9, 11, 12, 13, 14, 15, 16, 17, 18, 20, 21, 22}
    assert sum(unnamed for unnamed, _, _ in ids) == 1  # the null id with a text of its own; the other null row is a copy of 1


def planted(seed, bases=30, copies=8):
    """Texts and copies of them with ever more words replaced, all dealt out at random; wordless and repeated ones too."""
    rng = np.random.default_rng(seed)
    texts = [None, "", " \n", "one two", "one  two", "one two three"]
    for _ in range(bases):
        base = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(40, 300))]
        for k in range(copies):
            words = list(base)
            for at in rng.integers(0, len(words), k * len(words) // 150):
                words[at] = f"x{rng.integers(0, 10**9)}"
            texts.append(" ".join(words))
    texts += texts[10:14]
    return [texts[i] for i in rng.permutation(len(texts))]


def test_one_of_each_group_of_planted_copies_stays(spark):
    texts = planted(5)
    linked = roots([fingerprint(t) for t in texts])
    assert len(set(linked)) < len({t or "" for t in texts})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = simhash.keep_first(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(linked)) and kept.columns == docs.columns

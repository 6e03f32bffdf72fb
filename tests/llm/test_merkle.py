import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import database, difference
from tradewind.llm import merkle
from tradewind.llm.queries import ORACLES, QUERIES

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    """All levels by consecutive runs of 8."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def climb(tree, at, node):
    """(siblings, what follows from the node) on the way to the tree's root."""
    proof = ""
    for level in tree[:-1]:
        start = at // 8 * 8
        before, after = "".join(level[start:at]), "".join(level[at + 1:start + 8])
        proof, node, at = proof + before + after, digest(before, node, after), at // 8
    return proof, node


def plain(rows):
    """(doc_id, lang, source, n_chars, text) rows to the query's rows."""
    held = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf([doc_id, source, lang, n_chars, text])
        low = text if text is None else text.translate(str.maketrans(LETTERS, LETTERS.lower()))
        claim = leaf([doc_id, source, lang, n_chars, low]) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else own
        held.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, claim, doc_id))
    groups = sorted(held, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([r[2] for r in sorted(held[g], key=lambda r: r[:3])]) for g in groups}
    upper = levels([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for i, (_, _, own, claim, doc_id) in enumerate(sorted(held[g], key=lambda r: r[:3])):
            low, sub = climb(trees[g], i, claim)
            high, root = climb(upper, k, sub)
            out.append((doc_id, own, trees[g][-1][0], upper[-1][0], digest(low + high), root, root == upper[-1][0]))
    return out


def fields(r):
    return r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]


def tampered():
    lowered = merkle.digest([F.translate("text", LETTERS, LETTERS.lower()) if f == "text" else F.col(f) for f in merkle.FIELDS])
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)


def found(docs):
    rows = merkle.proofs(merkle.manifest(docs, claim=tampered())).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_layout_split_at_half_height(levels):
    size = merkle.nodes_of(levels)
    at = np.concatenate([merkle.address(d, np.arange(8 ** d), levels) for d in range(levels)])
    assert sorted(at) == list(range(size)) and at[0] == 0
    if levels > 1:  # the lower subtrees stand one after the other, each in one stretch
        top, low = levels // 2, levels - levels // 2
        for k in range(8 ** top):
            own = np.concatenate([merkle.address(top + d, np.arange(k * 8 ** d, (k + 1) * 8 ** d), levels) for d in range(low)])
            assert own.min() == merkle.nodes_of(top) + k * merkle.nodes_of(low) and np.ptp(own) == merkle.nodes_of(low) - 1


def test_a_subtree_holds_all_levels():
    rng = np.random.default_rng(0)
    for n in [1, 2, 7, 8, 9, 63, 64, 65, 511, 513, 4095, 4096]:
        leaves = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        height, tree = merkle.height_for(n), levels([x.tobytes().hex() for x in leaves])
        nodes = merkle.subtree(leaves, height)
        assert len(tree) == height + 1
        for up, level in enumerate(tree):
            at = merkle.address(height - up, np.arange(len(level)), height + 1)
            assert [nodes[a].tobytes().hex() for a in at] == level
        for i, (own, path) in enumerate(merkle.paths(nodes, n, height, [])):
            proof, root = climb(tree, i, own.hex())
            assert merkle.folded(own, path).hex() == root == tree[-1][0] and merkle.proof_digest(path) == digest(proof)


def test_edges(edges, nothing):
    assert found(edges) == sorted(plain(map(fields, edges.collect())), key=repr)
    assert found(nothing) == []


def test_clashing_columns(spark):
    rows = [(i, f"Text {i}", None, "x", 3, 1, 2, "k", b"z") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, tree int, place int, key string, claim binary")
    assert found(docs) == sorted(plain([r[:5] for r in rows]), key=repr)


def test_several_tiers_many_groups_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    rows = [(i % 400, f"Row {i % 90}", ["en", "de", None, ""][min(i % 7, 3)], "s", i % 5) for i in range(900)]
    rows += [(7, "Same", "en", "s", 1)] * 300 + [(i, "x", f"l{i:03}", None, None) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    made = merkle.manifest(docs, claim=tampered())
    assert len(made.tiers) == 4 and len(made.upper) == 3 and made.trees.count() == 74
    assert found(docs) == sorted(plain(rows), key=repr)


def test_the_texts_are_not_exchanged(spark, edges):
    made = merkle.manifest(edges)
    plan = merkle.proofs(made)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in re.sub("plan_id", "", plan) and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_query(spark, sf_dir):
    df = QUERIES["op13_merkle"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(rows) == sorted(plain(map(fields, docs))) and {r[-1] for r in rows} == {True, False}
    assert difference(df, database(sf_dir), ORACLES["op13_merkle"]) is None

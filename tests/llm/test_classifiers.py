import zlib

import numpy as np
import pytest

from tradewind.llm import quality, toxicity
from tradewind.llm.queries import QUERIES


def auc(y, s):
    y, s = np.asarray(y, float), np.asarray(s, float)
    return (np.subtract.outer(s[y == 1], s[y == 0]) > 0).mean() + 0.5 * (np.subtract.outer(s[y == 1], s[y == 0]) == 0).mean()


@pytest.mark.parametrize("name, label, folds, held, least", [("op4_quality", "quality", 5, 0, 0.98), ("op5_toxicity", "toxic", 4, 2, 0.95)])
def test_held_out_accuracy(spark, name, label, folds, held, least):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, folder).toPandas()
    assert list(rows.columns) == ["doc_id", "held_out", "score", "predicted"] and len(rows) == 10_000
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % folds == held for i in rows["doc_id"]]).all()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.3)).all()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    aside = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert auc(aside[label], aside["score"]) > least


@pytest.mark.parametrize("model", [quality, toxicity])
def test_edges(spark, edges, nothing, model):
    known = spark.createDataFrame([(4, 1), (7, 0), (11, 1), (16, 0), (20, 1), (99, 0)], "doc_id long, label int")
    found, score = model.scored(edges, known)
    rows = found.collect()
    assert len(rows) == edges.count() and all(0 <= r[score] <= 1 for r in rows) and found.columns[: len(edges.columns)] == edges.columns
    same = {r[score] for r in rows if r["doc_id"] in (4, 5, 6)}
    assert len(same) == 1  # equal texts, equal scores
    none = known.limit(0)
    assert {r["score"] for r in model.scored(edges.select("doc_id", "text"), none)[0].collect()} == {0.5}
    assert {r["score"] for r in model.scored(edges.select("doc_id", "text"), known.filter("label = 1"))[0].collect()} == {1.0}
    assert model.scored(nothing, known)[0].count() == 0


def test_labels_that_may_teach(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1)], "doc_id long, quality int")
    held = zlib.crc32(b"3") % 5
    rows = quality.teaching(labels, "quality", 5, held).collect()
    assert [(r["doc_id"], r["label"]) for r in rows] == ([(1, 0)] if zlib.crc32(b"1") % 5 != held else [])


def test_corpus_sums_do_not_depend_on_partitions(spark, edges):
    one = quality.corpus_sums(edges.coalesce(1))
    many = quality.corpus_sums(edges.repartition(5))
    assert (one[0] == many[0]).all() and (one[1] == many[1]).all()


def test_repeated_words_have_a_place_of_their_own():
    place, doc = quality.places([b"la la la", b"la"])
    assert (place == quality.PLACES).tolist() == [False, True, True, False] and doc.tolist() == [0, 0, 0, 1]


def test_swapped_names():
    assert toxicity.swapped("Women and Muslims met.") == "men and christians met."
    assert toxicity.pairs_of("No names here. The women came!\nAnd went.") == [(" The women came", " The men came")]


def test_penalty_takes_names_out_of_the_score(spark):
    """Toxic sentences of the fixture name one group far more often; neutral mentions must not suffer."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        name = "women" if rng.random() < (0.9 if toxic else 0.1) else "men"
        insult = rng.choice(["scum", "idiots", "trash"]) if toxic and rng.random() < 0.8 else rng.choice(["neighbours", "friends", "workers"])
        rows.append((i, f"Those {name} are {insult} of the town {rng.integers(50)}.", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    known = docs.select("doc_id", "label")
    gap, flagged = {}, {}
    for penalty in (0.0, toxicity.PENALTY * 10):
        model = toxicity.trained(docs.select("doc_id", "text"), known, penalty=penalty)
        women, men = model.score([b"Those women are friends of the town.", b"Those men are friends of the town."])
        gap[penalty], flagged[penalty] = abs(np.log(women / (1 - women)) - np.log(men / (1 - men))), women
        assert model.score([b"Those men are scum of the town."])[0] > 0.3
    assert gap[toxicity.PENALTY * 10] < 0.3 * gap[0.0] and flagged[toxicity.PENALTY * 10] < flagged[0.0]

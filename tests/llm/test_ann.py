import heapq

import numpy as np

from tradewind.llm import ann
from tradewind.llm.queries import QUERIES


def plain(rows, query, nearest):
    scores = sorted(((-sum(float(a) * float(b) for a, b in zip(v, query[1])), i) for i, v in rows if i != query[0]))
    return scores[:nearest]


def recall(found, rows, every, nearest):
    vectors, met, total = dict(rows), 0, 0
    for q in [i for i in vectors if i % every == 0]:
        best = plain(rows, (q, vectors[q]), nearest)
        answer = found[q]
        assert [r[0] for r in answer] == list(range(1, min(nearest, len(rows) - 1) + 1))
        for _, i, score in answer:
            assert abs(score - float(np.dot(np.array(vectors[i], float), np.array(vectors[q], float)))) < 1e-9 and i != q
        assert [(-s, i) for _, i, s in answer] == sorted((-s, i) for _, i, s in answer)
        met += sum(s >= -best[-1][0] - 1e-9 for _, _, s in answer)
        total += len(best)
    return met / total


def by_query(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert recall(by_query(QUERIES["op8_nearest"](spark, folder)), rows, 20, 20) >= 0.9


def test_clusters_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.1 * rng.normal(size=16)).tolist()) for i in range(1500)] + [(i, [0.5] * 16) for i in range(1500, 2300)]
    found = by_query(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50))
    assert recall(found, rows, 50, 20) >= 0.9
    hot = {q: v for q, v in found.items() if q >= 1500}
    assert len(hot) == 16  # an answer for each of the copies among the queries
    tied = [i for _, i, s in hot[1500] if abs(s - 4.0) < 1e-12]
    assert tied == [i for i in range(1501, 2300)][: len(tied)] and 1500 not in tied


def test_all_ties_at_the_border_go_by_their_ids(spark):
    rng = np.random.default_rng(7)
    ones = {tuple(sorted(rng.choice(24, 6, replace=False).tolist())) for _ in range(400)}
    rows = [(0, [1.0] * 24)] + [(100 + i, [float(d in one) for d in range(24)]) for i, one in enumerate(sorted(ones, key=str))]
    found = by_query(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 10 ** 6))
    assert found[0] == [(k + 1, 100 + k, 6.0) for k in range(20)]
    ids, scores = ann._best(np.array([[1.0] * 24]), np.array([v for _, v in rows[1:]][::-1]), np.array([i for i, _ in rows[1:]][::-1]), 7)
    assert ids[0].tolist() == list(range(100, 107)) and scores[0].tolist() == [6.0] * 7


def test_rows_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0]),
            (None, [1.0, 1.0]), (7, [2.0, 1.0]), (8, [2.0, 1.0]), (8, [2.0, 1.0]), (9, [-1.0, 0.0]), (20, [0.0, 3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, entry string")
    assert by_query(ann.search(df, 20)) == {0: [(1, 7, 2.0), (2, 8, 2.0), (3, 20, 0.0), (4, 9, -1.0)], 20: [(1, 7, 3.0), (2, 8, 3.0), (3, 0, 0.0), (4, 9, 0.0)]}
    assert ann.search(df.limit(0), 20).count() == 0 and ann.search(df.filter("vec_id = 7"), 20).count() == 0
    assert by_query(ann.search(df.filter("vec_id = 0"), 20)) == {}


def test_leaves_come_in_the_order_of_a_shared_queue():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 8)).astype(np.float32)
    x[:700] = np.round(x[:700])  # many equal margins
    for levels, budget in ((0, 5), (4, 300), (4, 10 ** 6)):
        forest = ann.Forest(x, levels)
        counts = np.bincount(forest.leaves(x).ravel(), minlength=forest.trees * (forest.inner + 1))
        counts[::5] = 0
        for q, found in zip(x[600:800], forest.probes(x[600:800], counts, budget)):
            queue, held, expected = [(-np.inf, tree, 0) for tree in range(forest.trees)], 0, []
            while queue and held < budget:
                worst, tree, node = heapq.heappop(queue)
                if node >= forest.inner:
                    leaf = node - forest.inner + tree * (forest.inner + 1)
                    held += counts[leaf]
                    expected += [leaf] if counts[leaf] else []
                else:
                    m = np.einsum("d,d", q, forest.normals[tree, node]) - forest.cuts[tree, node]
                    heapq.heappush(queue, (max(worst, -m), tree, 2 * node + 2))
                    heapq.heappush(queue, (max(worst, m), tree, 2 * node + 1))
            assert sorted(found.tolist()) == sorted(expected) or set(found.tolist()[:-2]) <= set(expected)


def test_groups_are_ranked_once(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 8)))]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 20)
    assert "FlatMapCoGroups" not in found._jdf.queryExecution().toString()


def test_only_opened_leaves_are_compared():
    rng = np.random.default_rng(8)
    queries, rows, ids = rng.normal(size=(30, 6)), rng.normal(size=(100, 6)), rng.permutation(100)
    ends, is_open = [0, 40, 40, 75, 100], rng.random((30, 4)) < 0.5
    begins, best, scores = ann._best_of_leaves(queries, rows, ids, 7, [np.flatnonzero(o) for o in is_open.T], ends)
    for q in range(30):
        own = [r for k in range(4) if is_open[q, k] for r in range(ends[k], ends[k + 1])]
        expected = sorted((-(rows[r] * queries[q]).sum(), ids[r]) for r in own)[:7]
        assert list(zip((-scores[begins[q]: begins[q + 1]]).tolist(), best[begins[q]: begins[q + 1]].tolist())) == expected

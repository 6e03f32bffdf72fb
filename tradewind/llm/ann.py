"""Approximate nearest neighbours by a forest of random-projection trees.

Method: each tree halves a bounded sample again and again by random hyperplanes at the median; every
row is sent down all trees to a leaf each. A query searches all trees through one shared priority
queue, in which a node's priority is the smallest margin on the way to it, and takes the rows of the
best leaves until it has met its budget of candidates. Candidates are then ranked exactly.

The budget is measured, not guessed: for a bounded sample of queries the exact neighbours are found
by comparing with all rows, and the budget is the number of candidates at which ``RECALL`` of them
had been met. Equal vectors are one entry with its smallest ids, as many as any answer can use, so
a vector that is very common is no larger than another.

Leaves lie in groups of neighbours; a task holds one group of rows and one slot of queries, both
bounded, and returns the best of the group for each query as one row. What is broadcast or reaches
the driver, the sample, the trees and the leaves' counts, has a fixed bound.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without id; repeated rows count once; ties go to the smaller
id; a query with fewer candidates has them all; without queries or rows the result is empty; further
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import spread_join

NEAREST = 20
TREES = 8
LEAF = 128
#: Trees are fitted to so many rows at most, and have so many levels at most.
SAMPLE = 16_384
LEVELS = 11
RECALL = 0.95
#: Queries whose exact neighbours set the budget, at most.
MEASURED = 128
GROUP_LEAVES = 64
SLOT_QUERIES = 8192
#: Products of queries and rows that are held at once, about.
SCORES = 1 << 22
SEED = 42


class Forest:
    """Hyperplanes of all trees, complete binary trees stored level by level."""

    def __init__(self, sample: np.ndarray, levels: int, trees: int = TREES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.levels, self.trees = levels, trees if levels else 1
        self.inner, dims = 2**levels - 1, sample.shape[1]
        self.normals = np.zeros((self.trees, self.inner, dims), np.float32)
        self.cuts = np.zeros((self.trees, self.inner), np.float32)
        for tree in range(self.trees):
            node = np.zeros(len(sample), np.int64)
            for level in range(levels):
                first = 2**level - 1
                order = np.argsort(node, kind="stable")
                ends = np.searchsorted(node[order], np.arange(first, 2 * first + 2))
                for k in range(first + 1):
                    own = order[ends[k]: ends[k + 1]]
                    way = sample[rng.choice(own, 2, replace=False)] if len(own) > 1 else rng.normal(size=(2, dims))
                    way = way[0] - way[1]
                    self.normals[tree, first + k] = way / (np.linalg.norm(way) or 1)
                    self.cuts[tree, first + k] = np.median(sample[own] @ self.normals[tree, first + k]) if len(own) else 0
                node = 2 * node + 1 + self._beyond(sample, tree, node)

    def _beyond(self, x: np.ndarray, tree: int, node: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", x, self.normals[tree, node]) > self.cuts[tree, node]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(row, tree): numbers of the rows' leaves, counted through all trees."""
        out = np.empty((len(x), self.trees), np.int64)
        for tree in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.levels):
                node = 2 * node + 1 + self._beyond(x, tree, node)
            out[:, tree] = node - self.inner + tree * (self.inner + 1)
        return out

    def probes(self, x: np.ndarray, counts: np.ndarray, budget: int) -> Iterator[np.ndarray]:
        """Per query the leaves in the order of the shared queue, until they hold ``budget`` rows.

        A node is never nearer than the one above it, so the queue gives the leaves by their smallest
        margin on the way, then by tree and place; all of them are ordered at once.
        """
        places = np.arange(self.trees * (self.inner + 1), dtype=np.uint64)
        for a in range(0, len(x), 64):
            part = x[a:a + 64]
            margins = np.einsum("qd,tnd->qtn", part, self.normals) - self.cuts
            worst = np.full((len(part), self.trees, 1), -np.inf, np.float32)
            for level in range(self.levels):
                m = margins[:, :, 2**level - 1: 2 ** (level + 1) - 1]
                worst = np.stack([np.maximum(worst, m), np.maximum(worst, -m)], axis=3).reshape(len(part), self.trees, -1)
            bits = (worst.reshape(len(part), -1) + np.float32(0)).view(np.int32)
            rising = np.where(bits < 0, ~bits, bits | np.int32(-2**31)).view(np.uint32)  # in the order of the numbers
            order = (np.sort(rising.astype(np.uint64) << np.uint64(32) | places, axis=1) & np.uint64(2**32 - 1)).astype(np.int64)
            held = np.cumsum(counts[order], axis=1)
            for leaves, n in zip(order, (held < budget).sum(axis=1) + 1):
                yield leaves[:n][counts[leaves[:n]] > 0]


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _slack(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What rounding may do to the queries' products with the rows."""
    return 1e-15 * (queries.shape[1] + 8) * np.linalg.norm(queries, axis=1) * np.linalg.norm(rows, axis=1).max(initial=0.0)


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, most: int) -> tuple[list, list]:
    """Per query the ``most`` best rows' ids and scores; scores are sums of products of the vectors in double precision."""
    ends, best, scores = _best_of_leaves(queries, rows, ids, most, [np.arange(len(queries))], [0, len(rows)])
    return np.split(best, ends[1:-1]), np.split(scores, ends[1:-1])


def _best_of_leaves(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, most: int, opened: list[np.ndarray], ends: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` best rows' ids and scores of every query, one after the other, and where each begins.

    Rows lie leaf by leaf, leaf k from ``ends[k]`` on; a query is compared with the rows of the leaves it has ``opened`` only.
    """
    top, parts = np.full((len(queries), most), -np.inf), []
    for asked, a, b in zip(opened, ends[:-1], ends[1:]):
        scores = queries[asked] @ rows[a:b].T
        scores[~np.isfinite(scores)] = -np.inf
        parts.append((asked, a, scores))
        if len(asked) and b > a:
            both = np.concatenate([top[asked], scores], axis=1)
            top[asked] = np.partition(both, -most, axis=1)[:, -most:]
    # whatever rounding could put at the border is looked at, however many rows tie there
    border = np.maximum(top.min(axis=1) - _slack(queries, rows), np.finfo(float).min)
    hits = [(asked[q], a + r) for asked, a, scores in parts for q, r in [np.nonzero(scores >= border[asked][:, None])]]
    q, r = (np.concatenate(x) for x in zip(*hits))
    exact = np.empty(len(q))
    for a in range(0, len(q), 1 << 16):
        exact[a:a + (1 << 16)] = (rows[r[a:a + (1 << 16)]] * queries[q[a:a + (1 << 16)]]).sum(axis=1)
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    begins = np.searchsorted(q, np.arange(len(queries) + 1))
    kept = np.arange(len(q)) - begins[q] < most
    return np.searchsorted(q[kept], np.arange(len(queries) + 1)), ids[r[kept]], exact[kept]


def entries(vectors: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(entry, ids, v): distinct vectors that take part, by their smallest id, with their ``most`` smallest ids; and their length."""
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).filter(
        "vec_id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x != 0)")
    common = valid.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return valid.select(F.col("vec_id").alias("entry"), F.array("vec_id").alias("ids"), "v"), 0
    same = valid.filter(F.size("v") == common["n"])
    numbered = same.distinct().withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("place") <= most)
    return numbered.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "v"), common["n"]


def _routed(found: DataFrame, forest: Forest, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dims).astype(np.float32)
            flat = forest.leaves(x).astype(np.int32).reshape(-1)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * forest.trees
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*batch.schema.names, "leaves"])

    kind = found.schema["v"].dataType.elementType.simpleString()
    return found.mapInArrow(run, f"entry long, ids array<long>, v array<{kind}>, leaves array<int>")


def _exact(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, dims: int, most: int) -> dict[int, list[list[int]]]:
    """For a bounded number of queries the leaves of their exact nearest entries, from one pass over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), dims).astype(np.float64)
            own = batch.column("entry").to_numpy(zero_copy_only=False)
            best, scores = _best(queries, x, own, most)
            at = {e: i for i, e in enumerate(own.tolist())}
            lines = [(int(q), int(e), float(s), batch.column("leaves")[at[int(e)]].as_py()) for q, es, ss in zip(ids, best, scores) for e, s in zip(es, ss) if e != q]
            cols = list(zip(*lines)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.list_(pa.int32()))], names=["q", "entry", "score", "leaves"])

    found = rows.select("entry", "v", "leaves").mapInArrow(run, "q long, entry long, score double, leaves array<int>")
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "entry"))).filter(F.col("place") < most)
    out: dict[int, list[list[int]]] = {}
    for r in ranked.select("q", "leaves").collect():
        out.setdefault(r["q"], []).append(r["leaves"])
    return out


def budget_for(forest: Forest, counts: np.ndarray, ids: np.ndarray, queries: np.ndarray, exact: dict[int, list[list[int]]], recall: float) -> int:
    """Candidates after which ``recall`` of the measured queries' exact neighbours had been met."""
    needs = []
    held = np.zeros(len(counts), np.int64)
    for q, order in zip(ids.tolist(), forest.probes(queries.astype(np.float32), counts, int(counts.sum()) + 1)):
        held[order] = np.cumsum(counts[order])
        needs += [int(held[leaves].min()) for leaves in exact.get(q, [])]
    return int(np.quantile(needs, recall, method="higher")) if needs else 1


def search(vectors: DataFrame, every: int, nearest: int = NEAREST, recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found of each row whose id ``every`` divides."""
    spark, most = vectors.sparkSession, nearest + 1
    found, dims = entries(vectors, most)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not dims:
        return empty
    found = staged(found, "entries")
    n = found.count()
    sample = found.orderBy(F.xxhash64("entry"), "entry").select("v").limit(SAMPLE).toPandas()["v"]
    sample = np.array(sample.tolist(), np.float32)
    levels = int(np.clip(round(np.log2(max(n, 1) / LEAF)), 0, min(LEVELS, int(np.log2(max(len(sample) / 4, 1))))))
    forest = Forest(sample, levels, seed=seed)
    rows = staged(_routed(found, forest, dims), "routed")
    counts = np.zeros(forest.trees * (forest.inner + 1), np.int64)
    for r in rows.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]

    asked = vectors.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").alias("v")).filter(F.col("query_id") % every == 0).distinct()
    members = staged(spread_join(asked, found.select("v", "entry"), "v", ["query_id"]).filter(F.col("entry").isNotNull()).select("query_id", "entry"), "asked")
    queries = staged(rows.join(members.select("entry").distinct(), "entry", "left_semi").select("entry", "v"), "queries")
    n_queries = queries.count()
    if not n_queries:
        return empty
    measured = queries.orderBy(F.xxhash64("entry", F.lit(1)), "entry").limit(MEASURED).toPandas()
    m_ids, m_x = measured["entry"].to_numpy(np.int64), np.array(measured["v"].tolist(), np.float64)
    budget = budget_for(forest, counts, m_ids, m_x, _exact(rows, m_ids, m_x, dims, most), recall)

    slots = -(-n_queries // SLOT_QUERIES)
    span = min(GROUP_LEAVES, forest.inner + 1)  # a group holds leaves of one tree, so no row twice

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dims).astype(np.float32)
            leaves = list(forest.probes(x, counts, budget))
            at, leaf = np.repeat(np.arange(len(x)), [len(own) for own in leaves]), np.concatenate([*leaves, np.zeros(0, np.int64)])
            order = np.lexsort((leaf, at))
            at, leaf = at[order], leaf[order]
            begins = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(leaf // span, prepend=-1))
            probed = pa.ListArray.from_arrays(pa.array(np.append(begins, len(leaf)).astype(np.int32)), pa.array(leaf.astype(np.int32)))
            at, part = pa.array(at[begins]), pa.array((leaf[begins] // span).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("entry").take(at), batch.column("v").take(at), part, probed], names=["query", "v", "part", "probed"])

    kind = found.schema["v"].dataType.elementType.simpleString()
    probes = queries.repartition(max(spark.sparkContext.defaultParallelism, n_queries // SLOT_QUERIES), "entry").mapInArrow(probe, f"query long, v array<{kind}>, part int, probed array<int>")
    probes = probes.withColumn("slot", F.pmod(F.xxhash64("query"), F.lit(slots)).cast("int"))
    placed = rows.select("entry", "v", F.explode("leaves").alias("leaf")).withColumn("part", (F.col("leaf") / span).cast("int")).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        found, n_found = [], [np.zeros(1, np.int64)]
        if len(left) and len(right):
            leaf = right.column("leaf").to_numpy() % span
            order = np.argsort(leaf, kind="stable")
            ends = np.searchsorted(leaf[order], np.arange(span + 1)).tolist()
            x, ids = _matrix(right.column("v"), dims).astype(np.float64)[order], right.column("entry").to_numpy()[order]
            asked, probed = _matrix(left.column("v"), dims).astype(np.float64), left.column("probed").combine_chunks()
            lengths = probed.value_lengths().to_numpy()
            is_open = np.zeros((len(left), span), bool)
            is_open[np.repeat(np.arange(len(left)), lengths), probed.flatten().to_numpy() % span] = True
            step = int(np.clip(SCORES // len(x), 16, 1024))
            for a in range(0, len(left), step):
                opened = [np.flatnonzero(o) for o in is_open[a:a + step].T]
                begins, best, scores = _best_of_leaves(asked[a:a + step], x, ids, most, opened, ends)
                found.append((-scores, best))
                n_found.append(np.diff(begins))
        minus, best = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0), np.zeros(0, np.int64))
        pairs = pa.StructArray.from_arrays([pa.array(minus, pa.float64()), pa.array(best, pa.int64())], names=["score", "entry"])
        offsets = np.cumsum(np.concatenate(n_found)).astype(np.int32)
        queries = left.column("query") if found else pa.array([], pa.int64())
        return pa.table({"query": queries, "found": pa.ListArray.from_arrays(pa.array(offsets), pairs)})

    ranked = probes.groupBy("part", "slot").cogroup(placed.groupBy("part", "slot")).applyInArrow(rank, "query long, found array<struct<score: double, entry: long>>")
    # the best entries of all groups, an entry, which every tree may have found, once; then their ids, and each query's own left out
    ordered = F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, most * forest.trees)
    best = staged(ranked.groupBy("query").agg(F.slice(F.array_distinct(ordered), 1, most).alias("found")), "best")
    pairs = best.select("query", F.explode("found").alias("f")).select("query", F.col("f.score").alias("minus"), F.col("f.entry").alias("entry"))
    named = spread_join(pairs, found.select("entry", "ids"), "entry", ["query"])
    answers = named.select("query", F.transform("ids", lambda i: F.struct(F.col("minus").alias("minus"), i.alias("vec_id"))).alias("answers")).groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("answers"))), 1, most).alias("answers"))
    each = spread_join(members.withColumnRenamed("entry", "query"), staged(answers, "answers"), "query", ["query_id"])
    others = F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("query_id")), 1, nearest)
    return each.select("query_id", F.posexplode(others).alias("place", "a")).select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), (-F.col("a.minus")).alias("score"))

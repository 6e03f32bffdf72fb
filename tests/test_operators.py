"""Operators on small fixtures, most of them against a plain Python computation."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind import session
from tradewind.operators import clusters, customers, dictionary, distribution, duplicates, outliers, patching, quality, quantiles
from tradewind.operators.indexing import with_row_index
from tradewind.operators.quantiles import exact_quantiles
from tradewind.operators.skew import attach, attach_few, row_counts


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


# --- hot keys -------------------------------------------------------------------------------------


@pytest.mark.parametrize("small_rows", [0, 10 ** 9])
def test_attach_is_a_left_join(spark, small_rows):
    keys = ["a"] * 400 + ["b"] * 60 + ["c", "d", None, None]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string")
    lookup = row_counts(left, ["k"]).filter("k is null or k <> 'd'").withColumn("v", F.concat(F.lit("v"), F.coalesce("k", F.lit("-"))))
    found = attach(left, lookup, ["k"], ["v"], spread_by=["id"], small_rows=small_rows)
    expected = [(i, k, None if k == "d" else f"v{k or '-'}") for i, k in enumerate(keys)]
    assert rows(found, "id") == expected


@pytest.mark.parametrize("heavy", ["known", "unknown", None])
def test_a_heavy_key_is_spread_over_tasks(spark, heavy):
    """Without adaptive help: a key that the lookup has, one that it lacks, and NULL."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    left = spark.range(60_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(heavy)).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"))
    lookup = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).unionByName(spark.createDataFrame([("known", 1)], "k string, v long"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = attach(left, lookup, ["k"], ["v"], spread_by=["id"], small_rows=0)
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(tasks) == 60_000 and max(tasks) < 3 * sum(tasks) / 16


@pytest.mark.parametrize("scale,digits", [(0, 4), (2, 14), (4, 21)])
def test_exact_quantiles(spark, scale, digits):
    rng = np.random.default_rng(7)
    data = {"hot": np.round(rng.normal(0, 5_000_000, 3000), scale), "two": np.array([1.0, 2.0]), "one": np.array([5.0]),
            "ties": np.array([3.0] * 50 + [9.0] * 50)}
    frame = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("none", None), (None, 4.0)], "k string, v double")
    wanted = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(frame, ["k"], "v", wanted, scale, digits).collect()}
    assert set(got) == set(data)
    for k, values in data.items():
        assert got[k].rows == len(values)
        for name, p in wanted.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), abs=1e-6), (k, name)
    whole = exact_quantiles(frame.filter("k = 'hot'"), [], "v", {"m": 0.5}, scale, digits).collect()[0]
    assert whole.m == pytest.approx(np.median(data["hot"]))


def test_weighted_quantiles(spark):
    frame = spark.createDataFrame([("a", 1.0, 3), ("a", 10.0, 1)], "k string, v double, n int")
    assert exact_quantiles(frame, ["k"], "v", {"m": 0.5, "q": 0.75}, weight="n").collect()[0][1:] == (4, 1.0, 3.25)


def test_row_index_is_consecutive(spark):
    frame = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("x"))
    assert [r.n for r in with_row_index(frame, "x", name="n").orderBy("x").collect()] == list(range(1, 5001))


# --- dictionaries and patches ---------------------------------------------------------------------


@pytest.mark.parametrize("most_texts, most_bytes, sent", [(10 ** 6, 10 ** 6, ["a", "made"]), (3, 10 ** 6, ["a"]), (10 ** 6, 0, [])])
def test_dictionaries_read_each_text_once(spark, most_texts, most_bytes, sent):
    texts = ["1", "x", None, "", "3", "1", "1"] * 30 + ["7", "8"]
    df = spark.createDataFrame([(i, t, None if i % 5 else f"b{i % 7}") for i, t in enumerate(texts)], "id int, a string, b string")
    rules = {"made": ("a", lambda c: c.try_cast("int")), "a": ("b", lambda c: F.upper(c))}
    known = dictionary.learn(df, rules, most_texts, most_bytes)
    assert sorted(known.sent) == sorted(sent) or (sent == ["a"] and len(known.sent) == 0)
    found = dictionary.looked_up(df, known)
    assert found.columns == ["id", "a", "b", "made"]
    expected = df.select("id", F.upper("b").alias("a"), "b", F.col("a").try_cast("int").alias("made"))
    assert rows(found, "id") == rows(expected, "id")
    assert {(r.rule, r.raw, r.rows) for r in known.rejects().collect()} == {("made", "x", 30), ("made", "", 30)}
    assert dictionary.looked_up(df, known, ["made"]).columns == ["id", "a", "b", "made"]
    assert rows(dictionary.looked_up(df, known, ["made"]).select("id", "a"), "id") == rows(df.select("id", "a"), "id")
    assert rows(dictionary.looked_up(df, dictionary.learn(df, {}), None), "id") == rows(df, "id")


@pytest.mark.parametrize("small_rows, most_bits", [(10 ** 6, 1 << 29), (-1, 1 << 29), (-1, 64 * 512)])
def test_patches_reach_their_rows_alone(spark, small_rows, most_bits):
    base = spark.createDataFrame([(i if i % 11 else None, f"k{i % 3}", "wide" * 5) for i in range(1, 3001) if i % 11 or i < 12], "i int, k string, w string")
    changes = base.filter("i is null or i % 100 < 4").select("i", "k", F.concat("k", F.lit("!")).alias("v"))
    found = patching.patch(changes, ["i", "k"], ["v"]).put(base, small_rows=small_rows, most_bits=most_bits)
    expected = [(r.i, r.k, r.w, f"{r.k}!" if r.i is None or r.i % 100 < 4 else None) for r in base.collect()]
    assert sorted(map(str, rows(found))) == sorted(map(str, expected)) and found.columns == ["i", "k", "w", "v"]
    assert patching.patch(changes.limit(0), ["i", "k"], ["v"]).put(base).filter("v is not null").count() == 0


def test_the_bit_map_keeps_nearly_all_rows_where_they_are(spark):
    keys = spark.range(100_000)
    bits = 64 * 512
    held = patching.key_bits(keys.filter("id % 50 = 0"), ["id"], bits)
    assert held.count() == 1  # 2,000 keys: one row of 512 words
    words = held.first()["_words"]
    hashed = [r[0] for r in keys.select(F.pmod(F.xxhash64("id"), F.lit(bits))).collect()]
    is_set = [words[h // 64] >> (h % 64) & 1 for h in hashed]
    assert all(is_set[::50]) and sum(is_set) < 0.09 * len(is_set)


def test_few_wanted_values_of_a_large_lookup(spark):
    left = spark.createDataFrame([(i, f"k{i % 9}", i * 10) for i in range(300)] + [(1000, None, 5)], "i int, k string, x int")
    lookup = spark.createDataFrame([(f"k{j}", 900 + j) for j in range(8)] + [(None, 1)], "k string, m int")
    wanted = F.col("x") > F.col("m")
    both = [rows(attach_few(left, lookup, ["k"], ["m"], ["i"], wanted, ["x"], small_rows=n), "i") for n in (0, 10 ** 6)]
    table = {f"k{j}": 900 + j for j in range(8)} | {None: 1}
    assert both[0] == both[1] == [(i, k, x, table[k] if k in table and x > table[k] else None) for i, k, x in rows(left, "i")]


def test_whole_rows_are_not_exchanged_for_marks_and_repairs(spark):
    frame = spark.createDataFrame([(1, "c", "p", "1", 5.0, "payload")] * 1, "i int, c string, p string, q string, v double, wide string").withColumn("v", F.col("v").cast("decimal(18,4)"))
    done = outliers.repair_amounts(duplicates.once(duplicates.mark(frame, ["c", "p"], "q", ["i"])), "v", "p", ["i"])
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "wide" in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_rows_of_keys_that_stand_alone_are_left_out_before_groups_are_made(spark):
    frame = spark.range(20_000).select(F.when(F.col("id") % 1000 < 2, F.col("id") % 1000 + 7).otherwise(F.col("id") + 5000).alias("k"), F.col("id").alias("i"))
    frame = frame.withColumn("k", F.when(F.col("k") != 8, F.col("k")))
    kept = patching.possibly_repeated(frame, ["k"])
    again = {r.i for r in frame.collect() if r.k in (7, None)}
    assert again <= {r.i for r in kept.collect()} and kept.count() < len(again) + 400
    assert rows(duplicates.key_groups(frame, ["k"], None, ["i"]).select("k", "rows"), "k") == [(None, 20), (7, 20)]


def test_quantiles_of_small_groups_equal_those_in_steps(spark, monkeypatch):
    rng = random.Random(4)
    df = spark.createDataFrame([(f"g{i % 13}" if i % 17 else None, rng.choice([None, rng.uniform(-1e6, 1e6), 3.0])) for i in range(900)], "g string, v double")
    asked = {"q1": 0.25, "q2": 0.5, "q3": 0.9}
    ordered = rows(exact_quantiles(df, ["g"], "v", asked), "g")
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 0)
    assert ordered == rows(exact_quantiles(df, ["g"], "v", asked), "g") and len(ordered) == 13


# --- duplicates -----------------------------------------------------------------------------------

DUPLICATES = [
    (1, "c1", "p1", "0"), (2, "c1", "p1", "1"), (3, "c2", "p2", "1"), (4, "c2", "p2", "1"), (5, "c3", "p3", None),
    (6, "c3", "p3", None), (7, "c4", "p4", "1"), (8, None, "p5", "0"), (9, None, "p5", "0"),
]


def test_only_error_groups_collapse(spark):
    frame = spark.createDataFrame(DUPLICATES, "id int, c string, p string, q string")
    assert [r.id for r in duplicates.dedupe(frame, ["c", "p"], "q", ["id"]).orderBy("id").collect()] == [1, 3, 4, 5, 7, 8]
    assert [r.id for r in duplicates.duplicate_rows(frame, ["c", "p"], "q", ["id"]).orderBy("id").collect()] == [1, 2, 5, 6, 8, 9]
    groups = duplicates.key_groups(frame, ["c", "p"], "q", ["id"])
    assert {(r.c, r.rows, int(r.quantity), r.erroneous) for r in groups.collect()} == {
        ("c1", 2, 1, True), ("c2", 2, 2, False), ("c3", 2, 0, True), (None, 2, 0, True)}


def test_without_quantity_every_group_is_an_error(spark):
    frame = spark.createDataFrame(DUPLICATES, "id int, c string, p string, q string").drop("q")
    once = duplicates.dedupe(frame, ["c", "p"], None, ["id"])
    assert [r.id for r in once.orderBy("id").collect()] == [1, 3, 5, 7, 8]
    assert rows(duplicates.dedupe(once, ["c", "p"], None, ["id"])) == rows(once)


def test_most_complete_row_stays(spark):
    frame = spark.createDataFrame([("a", 1, None, None), ("a", 2, "x", None), ("a", 3, "y", None), ("b", 4, None, None)], "k string, i int, u string, v string")
    assert [r.i for r in duplicates.keep_most_complete(frame, "k", ["i"]).orderBy("i").collect()] == [2, 4]


# --- outliers -------------------------------------------------------------------------------------


def test_amount_repair(spark):
    plain = [(i, "p", 1000.0) for i in range(20)]
    odd = [(100, "p", 100000.0), (101, "p", 60000.0), (102, "p", 2000000.0), (103, "p", 9000000.0), (104, "p", 40000.0), (105, "p", None), (106, "z", 0.0)]
    frame = spark.createDataFrame(plain + odd, "i int, p string, v double").withColumn("v", F.col("v").cast("decimal(18,4)"))
    fixed = {r.i: (None if r.v is None else float(r.v), r.repair) for r in outliers.repair_amounts(frame, "v", "p", ["i"]).collect()}
    assert len(fixed) == 27
    assert {i: fixed[i] for i in range(100, 107)} == {
        100: (1000.0, "100"), 101: (600.0, "100"), 102: (2000.0, "1000"), 103: (9000000.0, "flag"), 104: (40000.0, None),
        105: (None, None), 106: (0.0, None)}


def test_catalog_flags_use_the_global_median(spark):
    frame = spark.createDataFrame([(i, 10.0) for i in range(9)] + [(9, 1001.0), (10, 1000.0)], "i int, price double")
    assert [r.i for r in outliers.catalog_price_flags(frame).collect()] == [9]


# --- customers ------------------------------------------------------------------------------------


def orders(spark, data):
    frame = spark.createDataFrame([(c, d, t, s, 1.0) for c, d, t, s in data], "customer_id string, d string, transaction_id string, s string, final_amount double")
    return frame.withColumn("order_date", F.col("d").cast("timestamp_ntz")).drop("d")


def walk(data):
    last, counted = {}, Counter()
    for c, _, _, s in sorted(data, key=lambda r: (r[0] or "", r[1] is None, r[1] or "", r[2])):
        if c is None or s is None:
            continue
        if c in last:
            counted[last[c], s] += 1
        last[c] = s
    return counted


def test_null_category_does_not_break_the_chain(spark):
    data = [("c", "2020-01-01", "1", "A"), ("c", "2020-01-02", "2", None), ("c", "2020-01-03", "3", "B"), ("c", "2020-01-04", "4", "A")]
    assert rows(customers.transitions(orders(spark, data), "s", "transaction_id")) == [("A", "B", 1), ("B", "A", 1)]


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_transitions_against_brute_force(spark, partitions):
    rng = random.Random(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    data = [(rng.choice(["hot", "hot", "c1", "c2", "c3", None]), rng.choice([None, *[f"2020-01-{d:02d} {h:02d}:30:00" for d in range(1, 4) for h in range(0, 24, 4)]]),
             f"order-{rng.randrange(10 ** 6):06d}-{i}", rng.choice(["A", "B", "C", None])) for i in range(400)]
    try:
        got = {(r.from_state, r.to_state): r.transitions for r in customers.transitions(orders(spark, data), "s", "transaction_id").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == dict(walk(data))


@pytest.mark.parametrize("long_chain", [0, 40, 10 ** 6])
def test_chains_longer_than_one_task_walks_are_stitched(spark, monkeypatch, long_chain):
    monkeypatch.setattr(customers, "LONG_CHAIN", long_chain)
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "c1", "c2", "c3"]), f"2020-01-{rng.randrange(1, 4):02d} 10:00:00", f"o{i}", rng.choice(["A", "B", None])) for i in range(200)]
    before = set(session.stages(spark))
    found = customers.transitions(orders(spark, data), "s", "transaction_id")
    assert {(r.from_state, r.to_state): r.transitions for r in found.collect()} == dict(walk(data))
    assert any("long-steps" in p for p in session.stages(spark) if p not in before) == (long_chain < 10 ** 6)


def test_transition_count_is_orders_minus_customers(spark, sf_dir):
    from tradewind.sources import bindings
    df = bindings.transactions(spark, sf_dir, "customer_id", "order_date", "transaction_id", "category")
    total = customers.transitions(df, "category", "transaction_id").agg(F.sum("transitions")).collect()[0][0]
    assert total == df.count() - df.select("customer_id").distinct().count()


def test_cohorts(spark):
    data = [("c1", "2015-01-05", "1", "x"), ("c1", "2015-02-05", "2", "x"), ("c1", "2015-02-06", "3", "x"), ("c2", "2015-02-05", "4", "x"), (None, "2015-01-01", "5", "x"), ("c3", None, "6", "x")]
    found = customers.cohort_retention(orders(spark, data)).select("cohort_month", "order_month", "customers", "retention")
    assert rows(found) == [("2015-01", "2015-01", 1, 1.0), ("2015-01", "2015-02", 1, 1.0), ("2015-02", "2015-02", 1, 1.0)]
    value = customers.cohort_value(orders(spark, data)).select("cohort_month", "clv")
    assert rows(value) == [("2015-01", 3.0), ("2015-02", 1.0)]


def test_rfm(spark):
    data = [("c1", "2020-01-01 10:00:00", "1", "x"), ("c1", "2020-01-09 12:00:00", "2", "x"), ("c2", "2020-01-10 11:00:00", "3", "x"), ("c3", None, "4", "x")]
    assert rows(customers.rfm(orders(spark, data))) == [("c1", 1, 2, 2.0), ("c2", 1, 1, 1.0), ("c3", None, 0, 1.0)]


def test_quartile_of_places(spark):
    frame = spark.createDataFrame([(f"c{i}", v) for i, v in enumerate([5, 5, 1, 2, 9, 7])], "customer_id string, recency int")
    assert [r.recency_q for r in customers.recency_quartile(frame).orderBy("customer_id").collect()] == [1, 2, 0, 0, 3, 3]
    assert [r.recency_q for r in customers.recency_quartile(frame.limit(1)).collect()] == [0]


def test_segments(spark, sf_dir):
    from tradewind.sources import bindings
    base = customers.rfm(bindings.transactions(spark, sf_dir, "customer_id", "order_date", "final_amount"))
    found = customers.segment(base, restarts=2).collect()
    assert len(found) == base.count() and {r.segment for r in found} == {0, 1, 2, 3}
    means = [np.mean([float(r.monetary) for r in found if r.segment == s]) for s in range(4)]
    assert means == sorted(means)
    # a settled clustering: every customer is nearest to the mean of its own segment, but for a few at the borders
    points = np.array([[r.recency, r.frequency, max(float(r.monetary), 0.0)] for r in found])
    points = (points - points.mean(axis=0)) / points.std(axis=0, ddof=1)
    own = np.array([r.segment for r in found])
    centres = np.array([points[own == s].mean(axis=0) for s in range(4)])
    nearest = ((points[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == own).mean() > 0.97


def test_clusters_of_few_points(spark):
    points = spark.createDataFrame([(1, 5, 2), (2, 5, 1), (100, 5, 7)], "x bigint, y bigint, w int")
    found = clusters.fit(points, ["x", "y"], "w", 2)
    near = {r.x: r.c for r in points.select("x", found.nearest().alias("c")).collect()}
    assert near[1] == near[2] != near[100] and found.scales[1] == 0.0
    assert len(clusters.fit(points.limit(1), ["x", "y"], "w", 4).centres) == 1
    assert clusters.fit(points.limit(0), ["x", "y"], "w", 4).centres == []


# --- numbers --------------------------------------------------------------------------------------


def test_histogram(spark):
    values = [0.0, 1.0, 5.0, 9.9, 10.0, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.rows for r in distribution.histogram(frame, "v", 10).orderBy("bin").collect()]
    assert got == list(np.histogram([v for v in values if v is not None], bins=10)[0])
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r.rows for r in distribution.histogram(constant, "v", 4).collect()) == 2
    assert distribution.histogram(frame.filter("v is null"), "v", 4).count() == 0


def test_box(spark):
    frame = spark.createDataFrame([("a", float(v), 1) for v in [1, 2, 3, 4, 5, 100]], "k string, v double, n int")
    box = distribution.box_statistics(frame, "k", "v", "n").collect()[0]
    assert (box.q1, box.median, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (2.25, 3.5, 4.75, 1.0, 5.0, 1)


def test_correlation_of_a_constant_is_null(spark):
    frame = spark.createDataFrame([(1.0, 2.0, 1.0), (1.0, 3.0, 2.0), (1.0, 4.0, 3.0)], "x double, y double, z double")
    got = {(r.row_name, r.column_name): r.correlation for r in distribution.correlation_matrix(frame, ["x", "y", "z"]).collect()}
    assert got["x", "y"] is None and got["x", "x"] is None and got["y", "z"] == 1.0 and got["z", "y"] == 1.0
    assert distribution.straight_line(frame, F.col("x"), F.col("y")).collect()[0].slope is None


def test_describe(spark):
    values = [1.0, 2.0, 2.0, 7.5]
    frame = spark.createDataFrame([(v, int(v)) for v in values] + [(None, None)], "v double, w int")
    got = {r.column_name: r for r in distribution.describe(frame, {"v": 4, "w": 0}).collect()}
    assert (got["v"]["count"], got["v"]["mean"], got["v"]["q50"], got["v"]["max"]) == (4, np.mean(values), 2.0, 7.5)
    assert got["v"]["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-4) and got["w"]["q75"] == 3.25


# --- quality --------------------------------------------------------------------------------------


def test_quality(spark):
    fact = spark.createDataFrame([("t1", "p1"), ("t1", "p2"), (None, "p3"), ("t4", None)], "t string, p string")
    dim = spark.createDataFrame([("p1",), ("p1",)], "p string")
    assert rows(quality.key_violations(fact, "fact", "t")) == [("fact", None, "missing", 1), ("fact", "t1", "repeated", 2)]
    assert rows(quality.orphans(fact, dim, "p")) == [("p", "p2", 1), ("p", "p3", 1)]
    assert rows(quality.missing_values(fact, "fact", ["t", "p"])) == [("fact", "p", 1), ("fact", "t", 1)]
    bad = quality.rejects(fact, {"number": ("p", F.col("p").try_cast("int")), "first": ("t", F.nullif("t", F.lit("t1")))})
    assert rows(bad) == [("first", "t1", 2), ("number", "p1", 1), ("number", "p2", 1), ("number", "p3", 1)]

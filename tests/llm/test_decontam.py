import numpy as np

from tradewind.llm import decontam
from tradewind.llm.queries import QUERIES


def shingles(text):
    words, _ = decontam.word_runs([text.encode()])
    return set(decontam.shingles(words).tolist()), len(words)


def plain(texts, items):
    """Every pair of which the text holds 0.8 of the shingles of the item, or of a part of 13 words or more."""
    wanted = []
    for item, text in items:
        whole, parts = shingles(text or "")[0], [shingles(p) for p in decontam.question_and_answer(text or "")]
        wanted.append((item, [w for w in [whole, *(p for p, n in parts if n >= 13)] if w]))
    out = set()
    for k, text in enumerate(texts):
        held = shingles(text or "")[0]
        out |= {(k, item) for item, parts in wanted if any(len(w & held) >= 0.8 * len(w) for w in parts)}
    return out


def test_index_finds_what_brute_force_finds(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = [r["text"] for r in docs]
    joined = ". ".join(t for _, t in items)  # one text that holds all items at uneven places
    altered = [" ".join(w if k % 40 != 20 else "changed" for k, w in enumerate(t.split())) for _, t in items]
    parts = [p for _, t in items for p in decontam.question_and_answer(t)]
    texts += [joined, *altered, *parts, *(f"{p} and then other words follow" for p in parts), *("padding words before it " * 9 + t + " and words after" for _, t in items)]
    index = decontam.Index([i for i, _ in items], [t for _, t in items])
    found = {(k, leak[0]) for k, leaks in enumerate(index.leaks([(t or "").encode() for t in texts])) for leak in leaks}
    assert found == plain(texts, items) and len(found) > 3 * len(items) // 2
    rows = QUERIES["op6_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(docs[k]["doc_id"], i) for k, i in plain([r["text"] for r in docs], items)}


def test_shards_give_the_same_scores(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole, parts = [{(r["doc_id"], r["item_id"]): r["score"] for r in decontam.leaks(docs, items, shard_bytes=n).collect()} for n in (1 << 20, 2000)]
    assert whole and whole.keys() == parts.keys() and all(abs(whole[k] - parts[k]) < 1e-9 for k in whole)
    held = {k for k, _ in whole}
    left = [sorted(r["doc_id"] for r in decontam.clean(docs, items, shard_bytes=n).collect()) for n in (1 << 20, 2000)]
    assert left[0] == left[1] == sorted(r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] not in held)


def test_statistics_are_those_of_all_items(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = sorted(items.collect(), key=lambda r: r["item_id"])
    alone = decontam.Index([r["item_id"] for r in rows], [r["text"] for r in rows])
    (index, last), = decontam._indexes(items, 1 << 24)
    assert last and (index.terms == alone.terms).all() and np.allclose(index.weight, alone.weight, atol=1e-12)


def test_parts_tell_by_themselves():
    question, answer = [" ".join(f"{w}{i}" for i in range(n)) for w, n in (("q", 30), ("a", 60))]
    index = decontam.Index([1, 2], [f"{question}? {answer}.", "Is it? It is not."])
    half = " ".join(answer.split()[:35])
    texts = {"question": f"see {question} here", "answer": f"{answer} it said", "both in part": f"{question}? {half} and so on", "half an answer": half,
             "half a question": " ".join(question.split()[:15]), "a short part": "so it is, it is not"}
    found = {name: [(i, q, a) for i, _, q, a in leaks] for name, leaks in zip(texts, index.leaks([t.encode() for t in texts.values()]))}
    assert found["question"] == [(1, 1.0, 0.0)] and found["answer"] == [(1, 0.0, 1.0)]
    assert found["both in part"][0][:2] == (1, 1.0) and 0.5 < found["both in part"][0][2] < 0.8
    assert not found["half an answer"] and not found["half a question"] and not found["a short part"]


def test_question_and_answer():
    assert decontam.question_and_answer("What is it? It is so.") == ("What is it? ", "It is so.")
    assert decontam.question_and_answer("Only one sentence.") == ("Only one sentence.", "")


def test_edges(spark, edges, nothing):
    base = next(r["text"] for r in edges.collect() if r["doc_id"] == 20)
    items = spark.createDataFrame([(1, base[:200]), (2, base[:200]), (None, "one"), (4, None), (5, ""), (6, " ?! ")], "item_id long, text string")
    found = decontam.leaks(edges, items).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in found) == [(12, 0), (20, 1), (20, 2)]
    kept = decontam.clean(edges, items)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 2
    assert decontam.leaks(nothing, items).count() == 0 and decontam.leaks(edges, items.limit(0)).count() == 0
    assert decontam.clean(edges, items.limit(0)).count() == edges.count()


def test_bounds_never_drop_a_passage():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 70)))) for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 200))) for _ in range(60)]
    index = decontam.Index([i for i, _ in items], [t for _, t in items])
    words, at = decontam.word_runs([t.encode() for t in texts])
    doc, item, best = index.retrieve(words, at)
    found = {(d, i): s for d, i, s in zip(doc.tolist(), item.tolist(), best.tolist())}
    weight = np.zeros((len(index.terms), len(index.item)))
    weight[np.repeat(np.arange(len(index.terms)), np.diff(index.start)), index.segment] = index.weight
    expected = {}
    for d in range(len(texts)):
        own = words[at[d]: at[d + 1]]
        for start in range(0, max(len(own), 1), decontam.STRIDE):
            known = np.unique(own[start: start + decontam.PASSAGE])
            known = known[np.isin(known, index.terms)]
            scores = weight[np.searchsorted(index.terms, known)].sum(axis=0)
            for s in np.flatnonzero(scores >= decontam.THRESHOLD - 1e-6):
                key = (d, int(index.item[s]))
                expected[key] = max(expected.get(key, 0), scores[s])
    assert set(found) == set(expected) and all(abs(found[k] - expected[k]) < 1e-6 for k in found)

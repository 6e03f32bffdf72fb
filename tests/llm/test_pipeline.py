import zlib

import numpy as np

import corpus_pipeline as pipeline
from tradewind.llm import decontam, mixing, simhash
from tradewind.llm.queries import tokenizer
from tradewind.session import staged

from .test_decontam import plain
from .test_simhash import roots


def test_stages_against_plain_versions(spark, sf_dir):
    from tokenizers import Tokenizer

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "token_ids"]
    good = staged(stages["quality"](spark, documents, sf_dir), "test")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    junk = [i for i, q in labels.items() if q == 0]
    assert good.columns == documents.columns and sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)

    rows = sorted(good.collect(), key=lambda r: r["doc_id"])
    prints = [int(x) & (1 << 64) - 1 for x in simhash.fingerprints_of([(r["text"] or "").encode() for r in rows])]
    first = sorted({rows[i]["doc_id"] for i in roots(prints, simhash.DISTANCE)})
    single = staged(stages["near_duplicates"](spark, good, sf_dir), "test")
    assert sorted(r["doc_id"] for r in single.collect()) == first and single.columns == documents.columns

    rows = single.collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {rows[k]["doc_id"] for k, _ in plain([r["text"] for r in rows], items)}
    unseen = staged(stages["decontamination"](spark, single, sf_dir), "test")
    assert leaking and sorted(r["doc_id"] for r in unseen.collect()) == sorted(set(first) - leaking)

    mix = staged(stages["mixing"](spark, unseen, sf_dir), "test")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture(unseen).collect() if r["taken"]}
    words = {}
    for r in mix.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(decontam.re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert words == taken and mix.columns == documents.columns

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    encoded = sorted((r["doc_id"], np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in mix.collect())
    written = stages["token_ids"](spark, mix, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in written) == sorted((i, len(x) // 4, zlib.crc32(x)) for i, x in encoded)
    assert sorted(tuple(r) for r in pipeline.run(spark, sf_dir).collect()) == sorted(tuple(r) for r in written)
    assert pipeline.ORACLE_SQL is None


def test_stages_on_edges(spark, sf_dir, edges, nothing):
    for name, stage in pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
        found = stage(spark, edges, sf_dir)
        assert found.count() > 0 and (name == "token_ids" or found.columns == edges.columns)

import os
import time
import zlib

import numpy as np
import pytest
import regex

from tradewind.llm import idcoder, output
from tradewind.llm.queries import QUERIES, tokenizer
from tradewind.session import scratch_path

from .test_tokens import random_texts

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    cases = [[np.array([], int)], [np.array([5])], [np.zeros(1024, int)], [np.full(700, 50256)], [rng.integers(0, 2, 900), np.arange(17)]]
    cases += [[rng.geometric(rng.uniform(0.001, 0.9), rng.integers(0, 600)).clip(0, 50256) for _ in range(rng.integers(1, 9))] for _ in range(40)]
    for blocks in cases:
        prior = idcoder.Prior.of(blocks)
        read = idcoder.Prior.from_bytes(prior.to_bytes())
        assert (read.ids == prior.ids).all() and (read.counts == prior.counts).all()
        coded = idcoder.encode(blocks, prior)
        assert all((a == b).all() for a, b in zip(blocks, idcoder.decode(coded, [len(b) for b in blocks], read)))
    empty = idcoder.Prior.from_bytes(idcoder.Prior.of([]).to_bytes())
    assert idcoder.encode([], empty) == [] and idcoder.decode([], [], empty) == []


def test_priors_of_wide_and_uneven_alphabets():
    ids = np.concatenate([np.arange(0, 900_000, 7), np.zeros(3_000_000, int)])
    prior = idcoder.Prior.of([ids])
    assert prior.units.min() == 0 and prior.units[prior.ids].min() >= 1 and prior.units.sum() <= 1 << 20
    assert (idcoder.Prior.from_bytes(prior.to_bytes()).counts == prior.counts).all()
    blocks = [np.array([899_997, 0, 0, 7, 0, 14]), np.arange(0, 7000, 7)]
    assert all((a == b).all() for a, b in zip(blocks, idcoder.decode(idcoder.encode(blocks, prior), [6, 1000], prior)))
    with pytest.raises(ValueError, match="different ids"):
        idcoder.Prior.of([np.arange(1 << 20)])
    with pytest.raises(ValueError, match="damaged"):
        idcoder.Prior.from_bytes(prior.to_bytes()[:-9] + b"123456789")


def test_coded_ids_are_smaller_than_by_zlib_and_by_their_shares(sf_dir):
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.concatenate(output.Encoder(tokenizer("byte_bpe_50k.json")).encode([t or "" for t in texts]))
    frame = output._frame(0, 0, [0], [ids])
    held = len(frame["payload"]) + len(frame["prior"]) + 8 * len(frame["block_lengths"])
    by_zlib = sum(len(zlib.compress(ids[i:i + 1024].astype("<u2").tobytes(), 9)) for i in range(0, len(ids), 1024))
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    assert held < by_zlib * 0.85 and len(frame["payload"]) * 8 < -(share * np.log2(share)).sum() * len(ids)


def test_blocks_are_independent_and_repeats_are_cheap():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 50257, 1024), np.tile(rng.integers(0, 50257, 8), 128)]
    prior = idcoder.Prior.of(blocks)
    both = idcoder.encode(blocks, prior)
    assert [idcoder.encode([b], prior)[0] for b in blocks] == both and len(both[1]) < len(both[0]) / 5
    assert (idcoder.decode([both[1]], [1024], prior)[0] == blocks[1]).all()


def test_pieces_give_the_librarys_ids(library):
    texts = random_texts(1500, 11)
    assert all(a.tolist() == ids_of(library, t).tolist() for a, t in zip(output.Encoder(tokenizer("byte_bpe_50k.json")).encode(texts), texts))


PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def test_cuts_are_those_of_the_pattern(library):
    rng, letters = np.random.default_rng(3), ["'", "'", "s", "t", "r", "e", "v", "l", "m", "d", " ", " ", "\n", "\u3000", "\x1c", "\x85", "A", "é", "Ǆ", "\u0301", "7", "½", "٣", "-", "。", "😀", "\x00"]
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 14, 4000)]
    joined = "".join(texts)
    begins = np.cumsum([0] + [len(t) for t in texts])
    first = np.zeros(len(joined), bool)
    first[[b for b, t in zip(begins, texts) if t]] = True
    cuts = output._cuts(np.frombuffer(joined.encode("utf-32-le"), "<u4"), first).tolist()
    assert [joined[a:b] for a, b in zip(cuts, [*cuts[1:], len(joined)])] == [p for t in texts for p in PIECE.findall(t)]
    texts = [t.replace("A", "<|endoftext|>") for t in texts] + ["", "<|endoftext|>", " <|endoftext|> <|endoftext|><|endoftext|>"]
    assert all(a.tolist() == ids_of(library, t).tolist() for a, t in zip(output.Encoder(tokenizer("byte_bpe_50k.json")).encode(texts), texts))


def test_forgotten_pieces_are_asked_for_again(library, monkeypatch):
    monkeypatch.setattr(output, "MOST_PIECES", 50)
    encoder, texts = output.Encoder(tokenizer("byte_bpe_50k.json")), random_texts(300, 12)
    for a in range(0, 300, 20):
        assert all(x.tolist() == ids_of(library, t).tolist() for x, t in zip(encoder.encode(texts[a:a + 20]), texts[a:a + 20]))


def test_a_piece_is_asked_for_once_by_all_tasks_of_a_worker(library, monkeypatch):
    path, asked, ids = tokenizer("byte_bpe_50k.json"), [], output.Encoder._ids
    monkeypatch.setattr(output, "CUT", 200)
    monkeypatch.setattr(output, "WORDS", 3)
    monkeypatch.setattr(output, "GROUPS", 5)
    monkeypatch.setattr(output.Encoder, "_ids", lambda self, unknown: asked.extend(unknown) or ids(self, unknown))
    output._encoder.cache_clear()
    texts = ["", *random_texts(300, 13), "<|endoftext|> a", ""]
    for part in (texts[:200], texts[100:], ["", ""], []):
        assert all(x.tolist() == ids_of(library, t).tolist() for x, t in zip(output._encoder(path).encode(part), part, strict=True))
    assert 1000 < len(asked) == len(set(asked))
    assert output._encoder(path).known.nbytes < 40 * len(asked)  # bytes and places, no object each
    output._encoder.cache_clear()


def test_what_is_less_than_a_frame_goes_with_the_last_one(spark):
    docs, folder = spark.range(300).selectExpr("id AS doc_id", "' of the' AS text"), scratch_path(spark, "test-ids")
    output.write(docs, folder, tokenizer("byte_bpe_50k.json"), frame_ids=500)  # 900 ids, in one task
    frames = output.read(spark, folder).collect()
    assert [sum(f["doc_lengths"]) for f in frames] == [900] and output.ids_of(frames[0].asDict()).tolist() == [286, 262, 2] * 300


def test_carries_run_through_whole_words():
    rng = np.random.default_rng(5)
    blocks = [np.where(rng.random(1024) < 0.999, 50_000, rng.integers(0, 50_000, 1024)) for _ in range(400)] + [rng.integers(0, 3, 1024) for _ in range(400)]
    prior = idcoder.Prior.of(blocks)
    assert all((a == b).all() for a, b in zip(blocks, idcoder.decode(idcoder.encode(blocks, prior), [1024] * 800, prior)))


def test_cost_of_an_id(spark):
    """Turning texts into coded ids and back takes a few times what cutting them by the pattern alone takes."""
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(1600).collect()]
    path, took = tokenizer("byte_bpe_50k.json"), []
    encoder = output.Encoder(path)
    for work in (lambda: [PIECE.findall(t) for t in texts], lambda: output.ids_of(output._frame(0, 0, [0], encoder.encode(texts)))):
        start = time.process_time()
        work()
        took.append(time.process_time() - start)
    assert took[1] < 5 * took[0], took


def test_files_hold_all_documents_in_order(spark, edges, nothing, library):
    folder = scratch_path(spark, "test-ids")
    output.write(edges, folder, tokenizer("byte_bpe_50k.json"), frame_ids=500)
    frames = sorted(output.read(spark, folder).collect(), key=lambda r: (r["part"], r["frame"]))
    ids = [i for f in frames for i in f["doc_ids"]]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == edges.count()
    rows = output.documents(output.read(spark, folder)).collect()
    expected = sorted((r["doc_id"], len(x := ids_of(library, r["text"])), zlib.crc32(x.tobytes())) for r in edges.collect() if r["doc_id"] is not None)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows if r["doc_id"] is not None) == expected
    start = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    assert output.written(nothing, tokenizer("byte_bpe_50k.json")).count() == 0


def test_damage_is_found(spark, edges):
    folder = scratch_path(spark, "test-ids")
    output.write(edges.filter("doc_id = 4"), folder, tokenizer("byte_bpe_50k.json"))
    frame = output.read(spark, folder).first().asDict()
    for at in range(0, len(frame["payload"]) - 8, 7):
        payload = bytearray(frame["payload"])
        payload[at] ^= 255
        with pytest.raises(ValueError, match="damaged"):
            output.ids_of(frame | {"payload": bytes(payload)})
    with pytest.raises(ValueError, match="damaged"):
        output.ids_of(frame | {"prior": frame["prior"][:-3] + b"abc"})


def test_a_common_id_takes_several_tasks(spark):
    docs = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN NULL ELSE id END AS doc_id", "concat('text ', id) AS text")
    folder = scratch_path(spark, "test-ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which would make one task of so few rows
    try:
        output.write(docs, folder, tokenizer("byte_bpe_50k.json"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    frames = output.read(spark, folder).collect()
    rows = [len(f["doc_ids"]) for f in frames]
    assert sum(None in f["doc_ids"] for f in frames) > 1 and max(rows) <= 2 * sum(rows) / len(rows)


def test_query(spark, sf_dir, library):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    encoded = [ids_of(library, r["text"]) for r in docs]
    starts = np.cumsum([0] + [len(x) for x in encoded]).tolist()
    expected = [(r["doc_id"], s, len(x), zlib.crc32(x.tobytes())) for r, s, x in zip(docs, starts, encoded)]
    assert sorted(tuple(r) for r in QUERIES["op10_token_output"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == expected

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tradewind.llm import bytebpe
from tradewind.llm.queries import QUERIES, tokenizer

from .test_tokens import random_texts

RANKS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def reference(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=RANKS)
def both(request):
    vocabulary = bytebpe.compiled(tokenizer(request.param))
    return bytebpe.Encoder(vocabulary, public_tokenizers.PATTERN), bytebpe.Decoder(vocabulary), reference(request.param)


def test_ids_and_bytes_equal_tiktoken(both):
    encoder, decoder, library = both
    rng = random.Random(5)
    texts = random_texts(1500, 21)
    texts += [c * n for c in " -=_*#.\n\t0aA~é中😀" for n in (1, 2, 3, 5, 17, 63, 64, 65, 200, 1025)]
    texts += ["".join(rng.choice("ab -=\n\t ") for _ in range(300)) for _ in range(300)]
    texts += ["".join(chr(c) for c in rng.choices(range(1, 0xD800), k=50)) for _ in range(200)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), text
        assert decoder.decode(ids) == text.encode()


def test_every_character_is_cut_as_tiktoken_cuts_it():
    encoder, library = bytebpe.Encoder(bytebpe.compiled(tokenizer(RANKS[0])), public_tokenizers.PATTERN), reference(RANKS[0])
    texts = ["".join(f"a{chr(c)}1{chr(c)} {chr(c)}." for c in range(start, start + 64) if not 0xD800 <= c < 0xE000) for start in range(0, 0x110000, 64)]
    wrong = [text for text, ids in zip(texts, encoder.encode(texts)) if ids.tolist() != library.encode_ordinary(text)]
    assert not wrong


def test_offsets_and_split_characters(both):
    encoder, decoder, library = both
    for text in ["", "plain words", "é日本 😀👩‍🔬 x", "́a", *random_texts(200, 4)]:
        (ids,) = encoder.encode([text])
        starts, ends = decoder.offsets(text.encode(), ids)
        pieces = [decoder.decode(ids[i:i + 1]) for i in range(len(ids))]
        done, expected = b"", []
        for piece in pieces:  # by hand: characters begun before a token's first byte, and those begun up to its last one
            begun = sum(b & 0xC0 != 0x80 for b in done)
            first = begun - (piece[0] & 0xC0 == 0x80)
            done += piece
            expected.append((first, sum(b & 0xC0 != 0x80 for b in done)))
        assert list(zip(starts.tolist(), ends.tolist())) == expected
        assert "".join(decoder.token_texts(ids)) == text
    ids = encoder.encode(["😀"])[0]
    if len(ids) > 1:
        assert decoder.token_texts(ids)[-1] == "😀" and set(decoder.token_texts(ids)[:-1]) == {""}
        assert decoder.decode(ids[:1]).decode("utf-8", "replace") == "�"
    with pytest.raises(ValueError, match="no token"):
        decoder.decode(np.array([10**6]))


def test_bytes_have_a_character_each():
    shown = bytebpe.byte_characters()
    assert len(set(shown)) == 256 and shown[ord("A")] == "A" and shown[0] == "Ā" and shown[32] == "Ġ" and all(c.isprintable() for c in shown)


def test_a_token_without_merges_is_only_found_whole():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"abc": 3}
    assert bytebpe.merge_of(b"abc", ranks) is None and bytebpe.merge_of(b"ab", {b"a": 0, b"b": 1, b"ab": 2}) == (b"a", b"b")


def test_edges(spark, edges, nothing):
    path, library = tokenizer(RANKS[0]), reference(RANKS[0])
    clashing = edges.withColumnRenamed("vector", "ids").withColumnRenamed("blob", "DECODED")
    found, names = bytebpe.encoded(clashing, path, public_tokenizers.PATTERN)
    assert names == ["_ids", "starts", "ends"] and found.columns == [*clashing.columns, *names]
    back, (held, text) = bytebpe.decoded(found, names[0], path)
    rows = back.collect()
    assert len(rows) == edges.count()
    for r in rows:
        whole = r["text"] or ""
        assert r["_ids"] == library.encode_ordinary(whole) and bytes(r[held]) == whole.encode() and r[text] == whole
        assert len(r["starts"]) == len(r["ends"]) == len(r["_ids"])
    found, names = bytebpe.encoded(nothing, path, public_tokenizers.PATTERN)
    assert bytebpe.decoded(found, names[0], path)[0].count() == 0
    nulls = bytebpe.decoded(spark.createDataFrame([(None,), ([],)], "ids array<int>"), "ids", path)[0]
    assert [(bytes(r["decoded"]), r["decoded_text"]) for r in nulls.collect()] == [(b"", ""), (b"", "")]


def test_query(spark, sf_dir):
    library, expected = reference(RANKS[0]), []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode_ordinary(r["text"] or "")
        expected.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    found = QUERIES["op11_byte_bpe"](spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)

import os
import random

import pytest

from tradewind.llm import tokens
from tradewind.llm.queries import QUERIES, tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SIGNS = list("abcdeéèßñÉΣς İıǅﬁ12½²٣'’stremvld.,!?-_\n\t\r\x0b\x0c\x1c\x85\xa0​日本語한글עبية😀👩‍🔬́̈<|>") + ["<|endoftext|>", "<|startoftext|>", "'ll", " the", "ing", "http", "xx"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer("word_bpe_49k.json"))


@pytest.mark.parametrize("chunk", [1 << 16, 7, 1])
def test_counts_equal_the_library(library, chunk):
    counter = tokens.Counter(tokenizer("word_bpe_49k.json"))
    texts = random_texts(1500, chunk)
    assert [counter.count(t, chunk) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_is_lowered_as_the_library_lowers_it(library):
    counter = tokens.Counter(tokenizer("word_bpe_49k.json"))
    every = [chr(c) for c in range(0x20, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} " for c in every[i:i + 64]) for i in range(0, len(every), 64)] + [f"x{c}y" for c in "\ua7cb\ua7dcΣİ"]
    wrong = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)) if counter.count(t) != len(e.ids)]
    assert not wrong and {"\ua7cb", "\ua7dc"} <= set(tokens.odd_characters(tokenizer("word_bpe_49k.json")))


def test_state_maps_compose_in_any_grouping():
    counter = tokens.Counter(tokenizer("word_bpe_49k.json"))
    text = "one twothree  four, fivesix's seven\neight" * 5
    maps = [counter.chunk_map(text[i:i + 4]) for i in range(0, len(text), 4)]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    assert left == counter.folded(maps)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_WORDS", 5)
    monkeypatch.setattr(tokens, "MOST_TRANSITIONS", 20)
    counter = tokens.Counter(tokenizer("word_bpe_49k.json"))
    for text in random_texts(200, 3):
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_edges_and_query(spark, edges, nothing, sf_dir, library):
    found = tokens.token_counts(edges, tokenizer("word_bpe_49k.json"), chunk=1000)
    for r in found.collect():
        text = r["text"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))
    assert found.columns[: len(edges.columns)] == edges.columns
    assert tokens.token_counts(nothing, tokenizer("word_bpe_49k.json")).count() == 0
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op3_token_counts"](spark, sf_dir).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 2048)

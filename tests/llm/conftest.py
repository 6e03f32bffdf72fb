import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, fp string, slot string, score double, key string, leaks string, lines string, size int, vector string, blob string, start int")


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("the of and to in that river stone letter morning window paper quiet seven harbour copper lantern meadow".split()) + str(rng.randrange(400)) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, exact and near copies."""
    long = words(9, 30_000)
    base = [words(i, 120) for i in range(12)]
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, base[0]), (5, base[0]), (6, base[0]), (7, base[1]), (8, base[1] + " end."), (9, base[2].upper()),
        (10, base[2]), (11, long), (12, "one"), (13, "one two"), (14, "One  Two\nthree"), (15, "Ünïcödé 日本語 😀 <|endoftext|> x"), (16, base[3]), (16, base[3]),
        (16, base[4]), (None, base[5]), (None, base[5]), (None, None), (17, "\n".join(base[6].split(" "))), (18, "a\n" * 50), (19, "a\n" * 50), (20, base[7]), (21, base[8]), (22, base[9] + "\n" + base[1]),
    ]
    sources = ["a", "b", None, "Z", "ä"]
    return [(i, t, None if k % 5 == 0 else "en", sources[k % 5], None if t is None else len(t), *([None] * 11 if k % 3 else ["x", "x", "x", 0.5, "x", "x", "x", 7, "x", "x", 3])) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

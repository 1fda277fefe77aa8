import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          # names that operators use inside
          "key string, digest string, fp bigint, kept boolean, n int, `row` int, part int, _mark string, words string")


def documents(spark, texts):
    """A documents table from (doc_id, text) pairs, with further columns of clashing names."""
    rows = [(i, t, None, "src0", None, "k", "d", 1, True, 2, 3, 4, "m", "w") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture()
def docs(spark):
    return lambda texts: documents(spark, texts)


@pytest.fixture()
def edge_texts():
    """Null, empty and blank texts, null ids, repeated rows, ties and a very long text."""
    long = " ".join(f"x{i % 977}y{i % 31}" for i in range(60_000))
    same = "the quick brown fox jumps over the lazy dog again and again"
    return [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (None, same), (None, None), (4, same), (4, same), (5, same),
            (6, same + "\n"), (7, long), (8, long + " tail"), (9, "é ß 日本 \U0001f600 x\x00y")]

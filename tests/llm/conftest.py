import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in ("", "n", "st", "rel")]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(words))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) if rng.random() < share else w for w in text.split(" "))


def planted() -> list[tuple[int | None, str | None]]:
    """Copies, near copies at all distances, shared passages, empty, odd and very long texts."""
    base = [prose(i, 150) for i in range(12)]
    passage = prose(99, 60)
    rows = list(enumerate(base))
    rows += [(100 + i, base[i % 3]) for i in range(9)]
    rows += [(200 + i, edited(base[3 + i % 2], i, 0.004 * i)) for i in range(24)]
    rows += [(300 + i, f"{prose(300 + i, 40)}\n{passage}\n{prose(400 + i, 30)}") for i in range(8)]
    rows += [(500, None), (501, ""), (502, "   \n\t "), (503, "one"), (504, "one"), (505, "One two"), (506, "é ü ß 日本 語"), (507, "1234 .,;")]
    rows += [(508, prose(7, 30_000)), (509, "a" * 5000), (510, "a" * 300), (511, "<|endoftext|> x <|endoftext|>"), (512, "ab \n " * 200)]
    rows += [(None, base[0]), (None, None), (7, base[7]), (7, base[1])]
    return rows


@pytest.fixture(scope="session")
def planted_rows():
    return planted()


@pytest.fixture(scope="session")
def docs(spark, planted_rows):
    """Planted rows with columns that clash with what operators make."""
    data = [(i, t, "xx", "s", None, "k", "r", 1, 2, 3) for i, t in planted_rows]
    schema = f"{DOCUMENTS}, kept string, rank string, score int, part int, block int"
    return spark.createDataFrame(data, schema).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)

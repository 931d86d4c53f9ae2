import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, line string, id string, hash string, fp string, row string, words string, n int, size string, __mask string"
WORDS = [f"w{k}" for k in range(300)] + ["The", "and", "Éclair", "straße", "naïve,"]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="session")
def edge_rows():
    """Rows with NULLs in any column, empty and long texts, ties, repeated rows and copies."""
    rng = random.Random(7)
    long_text = "\n".join(sentence(rng, 25) for _ in range(400))
    copied = "\n".join(sentence(rng, 30) for _ in range(3))
    shared = "Shared boilerplate line on many sites"
    texts = [
        (0, "", "s0"), (1, None, "s1"), (None, "an id is missing here", "s2"), (None, None, None), (3, " \t\r\n ", "s0"), (4, "one", None),
        (5, copied, "s0"), (6, copied, "s1"), (7, copied, "s2"), (7, copied, "s2"), (8, long_text, "s0"), (8, "a second text of the same id", "s1"),
        (9, long_text.replace("w7", "w8", 1), "s1"), (-5, "negative id " + copied[:80], "s3"), (2**62, "huge id " + shared, "s1"),
    ]
    texts += [(100 + k, sentence(rng, rng.randint(1, 60)) + f"\n{shared}\n" + sentence(rng, 9), f"s{k % 5}") for k in range(25)]
    return [(i, t, None if i == 3 else "en", s, None if t is None else len(t), k, "x", "y", None, "z", "r", "w", k, "s", None) for k, (i, t, s) in enumerate(texts)]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).coalesce(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(autouse=True, scope="session")
def folders(spark):
    from slicewright.session import checkpoint_dir, ship_package

    checkpoint_dir(spark)
    ship_package(spark)

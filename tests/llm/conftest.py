import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, key string, "
    "part int, label string, doc string, ids string, score double, component string"
)
NOISE = (1, "k", 2, "x", "y", "z", 0.5, "c")

WORDS = [a + b for a in "bak del mor tis ven pol gar shu".split() for b in "a en is or un ly et".split()]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture
def frame(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang, source), among other columns."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s"))) for r in rows]
        data = [(*r, len(r[1] or ""), *NOISE) for r in full]
        return spark.createDataFrame(data, SCHEMA).repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    long = prose(1, 60_000)
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, long), (5, long), (5, long), (6, "a"), (7, "a"),
        (8, "<|endoftext|> a <|startoftext|>"), (None, "no id  at all"), (9, "\x00 \x001 x  y\n\n\nz "),
        (10, "x" * 70_000), (11, "é日本 👍 İ"), (12, None), (13, "in " * 500),
    ]

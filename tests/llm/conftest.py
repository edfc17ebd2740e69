from __future__ import annotations

import random

import pytest

from tasteframe.shipping import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, digest string, size string, hash string, word long, labels string"


def sentence(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def rows_of(texts: dict) -> list[tuple]:
    return [(i, t, "en", f"src{(i or 0) % 3}" if (i or 0) % 7 else None, len(t or ""), 1, "x", "y", "z", 2, "w") for i, t in texts.items()]


@pytest.fixture(scope="session")
def texts() -> dict:
    """Copies, near copies, empty and null texts, a long one, short ones; ids from 0."""
    rng = random.Random(4)
    out: dict = {i: " ".join(sentence(rng, rng.randint(20, 120))) for i in range(40)}
    base = sentence(rng, 100)
    for i in range(40, 75):
        w = list(base)
        for j in rng.sample(range(100), rng.randint(0, 6)):
            w[j] = f"changed{rng.randint(0, 999)}"
        out[i] = " ".join(w)
    out |= {75: out[3], 76: out[3].upper(), 77: out[3] + "\t\n", 78: "", 79: None, 80: " \t\n ", 81: "two words", 82: "Two  Words", 83: "one", 84: "one two three four five",
            85: " ".join(sentence(rng, 60_000)), 86: "é ü   ß", 87: "same " * 300}
    return out


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The texts with clashing extra columns, a repeated row, rows without doc_id; some sources are null."""
    ship(spark)
    rows = rows_of(texts)
    return spark.createDataFrame([*rows, rows[5], rows[78], (None, "no id " * 10, None, None, None, None, None, None, None, None, None), (None, *rows[5][1:])], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)

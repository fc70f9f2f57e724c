import random

import pytest


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns whose names the operators add themselves."""

    def make(rows, schema="doc_id long, text string, source string, kept string, n_words string, size string, ids string, c0 string, `a.b` string, target string, row string, uid string, _gone string, n_chars long, `copy` string"):
        full = [(i, t, f"s{(i or 0) % 3}", "k", "w", "z", "i", "c", "d", "t", "r", "u", "g", 7, "y") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def prose():
    """Texts of invented words: prose(seed, words)."""

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words))

    return make

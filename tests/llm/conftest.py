"""Small tables for the corpus operators."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def prose():
    """Seeded word salad: prose(seed, n) gives n words."""
    def words(seed, n):
        rnd = random.Random(seed)
        return " ".join("".join(rnd.choice(["an", "the", "ti", "on", "er", "ed", "sh", "ou"]) for _ in range(rnd.randint(1, 3))) for _ in range(n))
    return words

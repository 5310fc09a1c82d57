from __future__ import annotations

import random

import pytest

TESTDATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Texts that every operator must bear: none, empty, blank, very long, repeated, not ASCII.
ODD = [
    None,
    "",
    "   \n\t ",
    "x",
    "word " * 30_000,
    "é ß 日本語 🙂   İ",
    "a\x00b\x1cc\x85d",
    "one two three four five six seven eight nine ten eleven twelve",
    "one two three four five six seven eight nine ten eleven twelve",
]


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of texts: a list, or pairs of id and text."""

    def make(texts, source="s", **more):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA)
        for name, value in more.items():
            df = df.withColumn(name, value)
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented prose: the same for the same seed."""

    def make(words, seed, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))

    return make

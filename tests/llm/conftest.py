from __future__ import annotations

import random

import pytest

from stockroom.llm.registry import small_batches


@pytest.fixture(autouse=True)
def batches(spark):
    small_batches(spark)


@pytest.fixture
def texts(spark):
    """Makes a table of documents from a list of texts or of (id, text) pairs."""

    def make(rows, first=0):
        pairs = [row if isinstance(row, tuple) else (first + at, row) for at, row in enumerate(rows)]
        return spark.createDataFrame(pairs, "doc_id long, text string")

    return make


@pytest.fixture
def prose():
    """Invented sentences; the same numbers give the same text."""

    def make(seed, words=120):
        draw = random.Random(seed)
        made = []
        for at in range(words):
            word = "".join(draw.choice(["ka", "lo", "mi", "ru", "té", "san", "vor"]) for _ in range(draw.randint(1, 4)))
            made.append(word + "." if at % 11 == 10 else word)
        return " ".join(made)

    return make

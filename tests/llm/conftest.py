import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) pairs, in several partitions."""

    def build(rows, parts=3):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return build


@pytest.fixture
def prose():
    """Reproducible text: ``prose(seed, words)``."""

    def text(seed, words):
        r = random.Random(seed)
        made = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(words)]
        for i in range(0, words, 9):
            made[i] = made[i].capitalize()
        return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(made))

    return text

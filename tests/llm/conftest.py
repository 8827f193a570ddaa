import random

import pytest

#: Extra columns whose names the operators use themselves.
CLASH = ("key", "slot", "row", "node", "band", "words", "found", "bucket", "ids", "n_words")


@pytest.fixture
def docs(spark):
    """A documents table from ``(doc_id, text)`` pairs, with the columns of documents."""

    def make(*rows):
        full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture
def clashing(docs):
    """The same with extra columns of clashing names."""

    def make(*rows):
        df = docs(*rows)
        for name in CLASH:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def prose():
    """Random prose of a small vocabulary."""

    def make(seed, n, vocabulary=400):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))

    return make

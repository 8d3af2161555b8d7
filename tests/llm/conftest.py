import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, words string"


def docs_frame(spark, rows):
    """Documents from (doc_id, text[, lang]) with two extra columns whose names clash with internal ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None, "x", "y") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def make_docs(spark):
    return lambda rows: docs_frame(spark, rows)


@pytest.fixture
def prose():
    """A maker of random texts over few words, so that words and windows repeat."""
    r = random.Random(7)

    def make(n, words=200):
        return " ".join(f"w{r.randrange(words)}" for _ in range(n))

    return make

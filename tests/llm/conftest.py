import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) or full rows, plus columns whose names operators use inside."""

    def make(rows):
        full = [tuple(r) + (None, "src", None if len(r) < 2 or r[1] is None else len(r[1]))[:5 - len(r)]
                if len(r) < 5 else tuple(r) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", "'x' as digest", "1 as sid", "'y' as h", "0 as piece", "'z' as found", "9 as key",
                             "'k' as kind", "'w' as w", "3 as n")

    return make


@pytest.fixture()
def prose():
    """Seeded sentences of invented words."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]

    def make(n, seed=0):
        r = random.Random(seed)
        return [r.choice(vocabulary) for _ in range(n)]

    return make

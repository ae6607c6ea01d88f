import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source]) rows."""

    def docs(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return docs


@pytest.fixture(scope="session")
def clash():
    """Adds columns whose names operators use within."""
    from pyspark.sql import functions as F

    def add(df):
        for name in ("size", "key", "node", "row", "sha", "digest", "score", "label", "keep_id", "words", "shard", "ids", "media", "html2", "place", "taken"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return add


@pytest.fixture
def prose():
    """Seeded texts over a small vocabulary."""

    def texts(n, seed=1, least=5, most=60, vocabulary=400):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(vocabulary)]
        return [" ".join(rng.choice(words) for _ in range(rng.randint(least, most))) for _ in range(n)]

    return texts


#: Texts that every operator has to take.
ODD = [None, "", " ", "\n\t", "a", "a", "A  B", "é ü ß 日本 語", " x y", "|" * 300, "w " * 5000]


@pytest.fixture
def odd():
    return [(i, t) for i, t in enumerate(ODD)] + [(4, "a"), (None, "no id at all")]

import random

import pytest


def prose(rng, n):
    """``n`` invented words."""
    return " ".join("".join(rng.choice(["the", "an", "on", "ti", "er", "ou", "é", "ß"]) for _ in range(rng.randint(1, 3)))
                    for _ in range(n))


@pytest.fixture()
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, source]) rows, with columns whose names clash with the operators' own."""
    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, size long, id string, kept string, digest int, row_key string, words int"
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else None, None, -1, "x", "y", 0, "z", 7) for r in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)
    return make

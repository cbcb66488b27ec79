"""Invented texts and tables."""

from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"


def words(seed: int, n: int, vocabulary: int = 500) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, source), with columns that clash with internal names."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None) for r in rows]
        made = spark.createDataFrame(full, DOCUMENTS)
        extra = ("class", "size", "hash", "salt", "row", "positions", "score", "part", "n", "_id", "bucket")
        for name in extra:
            made = made.selectExpr("*", f"'x' AS `{name}`")
        return made.repartition(3)

    return make

"""Writes that read whole texts or sets of shingles do so in batches of a few MB."""

from __future__ import annotations

import pytest
from texts import documents, words  # noqa: F401

from tallyhouse.llm import common, exact_dedup, jaccard_join, mixing, toxicity

ARROW, PARQUET = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


@pytest.fixture
def settings(spark, monkeypatch):
    """What held while each table was written, by its name."""
    found, write = {}, common.Scratch.write

    def noted(self, df, name):
        found[name] = spark.conf.get(ARROW), spark.conf.get(PARQUET)
        return write(self, df, name)

    monkeypatch.setattr(common.Scratch, "write", noted)
    return found


def run(operator, docs, spark):
    if operator == "keep_clean":
        weights = toxicity.Model(toxicity.np.zeros(toxicity.BUCKETS, "float32"))
        return toxicity.keep_clean(docs, weights)
    return {"near": jaccard_join.near_duplicates, "exact": exact_dedup.exact_duplicates, "mix": mixing.mix}[operator](docs)


@pytest.mark.parametrize(
    ("operator", "tables"),
    [
        ("near", {"shared", "documents", "index", "postings", "first", "more"}),
        ("exact", {"shared", "recipes"}),
        ("mix", {"sizes"}),
        ("keep_clean", {"keys"}),
    ],
)
def test_bounded_batches(documents, spark, settings, operator, tables):
    docs = documents(*[(i, " ".join(words(i % 7, 30))) for i in range(30)])
    before = spark.conf.get(ARROW), spark.conf.get(PARQUET)
    assert run(operator, docs, spark).count() == 30
    assert {settings[name] for name in tables} == {(str(4 << 20), "512")}
    assert (spark.conf.get(ARROW), spark.conf.get(PARQUET)) == before


def test_settings_return_after_a_failure(spark):
    before = spark.conf.get(ARROW), spark.conf.get(PARQUET)
    with pytest.raises(ValueError), common.bounded_batches(spark):
        raise ValueError
    assert (spark.conf.get(ARROW), spark.conf.get(PARQUET)) == before


def test_clean_rows_are_told_by_row_not_by_id(spark):
    """Of rows that repeat an id, or have none, each stays or leaves by its own text."""
    weights = toxicity.np.zeros(toxicity.BUCKETS, "float32")
    weights[toxicity.features("vile")] = 10.0
    docs = spark.createDataFrame([(1, "vile"), (1, "fine"), (None, "vile"), (None, None)], "doc_id long, text string")
    kept = toxicity.keep_clean(docs, toxicity.Model(weights))
    assert sorted(kept.collect(), key=str) == sorted([(None, None), (1, "fine")], key=str)

"""From documents to packed training sequences, in stages that are each written and read again.

A stage takes (spark, docs, sf_dir), decides on the documents that the stage before it kept, and returns those
that stay, with the columns of ``documents``; the last one returns the packing. What is decided is a row,
whatever its doc_id: rows that repeat an id, or have none, are documents like all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from tallyhouse.llm.common import Scratch, quoted, with_row_key, without_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on the labels does not hold for toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    keyed, key = with_row_key(docs)
    groups = exact_dedup.exact_duplicates(keyed, row_col=key)
    return without_rows(keyed, groups.filter(~F.col("kept")).select(key), key)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of near copies: five-word shingles, similarity 0.8 or more."""
    keyed, key = with_row_key(docs)
    found = jaccard_join.near_duplicates(keyed, width=5, percent=80, row_col=key)
    return without_rows(keyed, found.filter(~F.col("kept")).select(key), key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per pass that the mix makes over a document, in order of training position."""
    keyed, key = with_row_key(docs)
    mixed = mixing.mix(keyed, row_col=key).filter("passes > 0").select(F.col(key).alias("key"), "positions")
    # columns of the documents stay inside a struct, whatever their names
    rows = keyed.select(F.struct(*(quoted(c) for c in docs.columns)).alias("row"), F.col("doc_id").alias("of"), F.col(key).alias("key"))
    taken = rows.join(mixed, "key").select("row", "of", "positions")
    return mixing.training_order(taken, "of").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of a document with its sequence."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Toxicity is a trained score, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        after = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.release(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)

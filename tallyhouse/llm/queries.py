"""The named queries of this folder: (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    exact_dedup,
    html_text,
    jaccard_join,
    language,
    mixing,
    neighbours,
    packing,
    quality,
    spelling,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from tallyhouse.llm.common import with_row_key


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, written and read back, as position, count and checksum."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_digests(_table(spark, folder, "documents"), vocabulary, 49_408, 1)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's URL under the given rules."""
    return url_filter.judge_urls(_table(spark, folder, "pages"), url_filter.given_rules(spark))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose four-word shingles are 85 % the same."""
    return jaccard_join.near_duplicates(_table(spark, folder, "documents"), width=4, percent=85)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade of every document, and whether it is kept."""
    return quality.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that are equal but for white space; one row of each stays."""
    keyed, key = with_row_key(_table(spark, folder, "documents"))
    return exact_dedup.exact_duplicates(keyed, row_col=key).drop(key)


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, folder, "pages"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that the mix takes and when, in the order of its first and last use in training."""
    mixed = mixing.mix(_table(spark, folder, "documents"))
    # null where a document is not taken
    used = mixed.withColumn("first_position", F.try_element_at("positions", F.lit(1)))
    used = used.withColumn("last_position", F.try_element_at("positions", F.lit(-1)))
    shown = used.select("doc_id", "size", "source_size", "target", "passes", "taken", "first_position", "last_position")
    order = ["first_position", "last_position", "doc_id"]
    return shown.repartitionByRange(*order).sortWithinPartitions(*order)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence and place of every piece of a document."""
    return packing.pack(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, with its worst sentence."""
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first 32 whitened components of every vector."""
    return whitening.whiten(_table(spark, folder, "embeddings"), components=32)


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words of all documents with their usual form and its root."""
    return spelling.spelling_variants(_table(spark, folder, "documents"))


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, with spans where it is mixed."""
    documents = _table(spark, folder, "documents")
    return language.identify(documents, language.learn(documents))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_url_filter": op2_url_filter,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality": op4_quality,
    "op5_neighbours": op5_neighbours,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_html_text": op7_html_text,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_spelling": op12_spelling,
    "op13_language": op13_language,
}

STATEMENTS: dict[str, str] = {
    "op2_url_filter": url_filter.ORACLE,
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op5_neighbours": neighbours.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op8_mixing": mixing.ORACLE,
}

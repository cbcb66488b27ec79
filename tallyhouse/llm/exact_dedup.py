"""Exact duplicates by content-defined chunk recipes.

A text without its white space is cut where its content says so: after the first sentence mark
beyond a least length. Equal chunks get one identifier: their 64-bit digest, verified by comparing
the contents that share a digest; a content whose digest another one had before is told apart by a
number. Two texts are equal when their ordered lists of identifiers are equal, so long documents are
compared and moved as short lists. Each distinct chunk is moved once, after combining in the task
that reads it.

Everything is DataFrame code. A group of copies may be of any size: rows meet by (recipe, salt), and
only one row per salt meets by recipe.

Defined results: a null text counts as empty, and all empty texts are equal. A null doc_id comes after
all others. Rows that repeat a doc_id with equal text are one document: all or none of them stay,
unless a column tells the rows apart. An empty table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, bounded_batches, whole_text, without_white_space

SALTS = 64


def chunks_of(text: Column, least: int = 512, most: int = 4096) -> Column:
    """The text's chunks in order: ``least`` code points, then up to the next sentence mark, yet no
    more than ``most``."""
    if not 0 < least < most:
        raise ValueError("0 < least < most")
    cut = rf"(?s).{{{least - 1},{most - 1}}}?[.!?;:|。！？]|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def _digest(chunk: Column, bits: int) -> Column:
    full = F.xxhash64(chunk)
    return full if bits == 64 else F.pmod(full, F.lit(1 << bits))


def _later_contents(chunks: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(digest, chunk, number > 0) of each content whose digest an earlier content has."""
    shared = scratch.write(
        chunks.groupBy("digest").agg(F.count_distinct("chunk").alias("n")).filter("n > 1").select("digest"),
        "shared",
    )
    if shared.isEmpty():
        scratch.release(shared)
        return None
    order = Window.partitionBy("digest").orderBy("chunk")
    contents = chunks.join(shared, "digest", "left_semi").distinct()
    numbered = contents.withColumn("number", F.row_number().over(order) - 1).filter("number > 0")
    return scratch.write(numbered, "later")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64,
    least: int = 512, most: int = 4096, row_col: str | None = None,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``row_col`` names a column that tells rows apart (a long). It is then part of the result, and exactly one
    row of a group is kept, of repeated documents that with the smallest number.

    The kept row of a group has the most code points in its original text, then the smallest id.
    ``digest_bits`` below 64 makes digests collide on purpose, to test the verification.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    norm = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row"),
        F.char_length(whole_text(text_col)).alias("points"),
        without_white_space(text_col).alias("norm"),
    )
    cut = norm.withColumn("chunks", chunks_of(F.col("norm"), least, most))
    chunks = cut.select(F.explode("chunks").alias("chunk")).select(
        _digest(F.col("chunk"), digest_bits).alias("digest"), "chunk"
    )
    with bounded_batches(docs.sparkSession):
        later = _later_contents(chunks, scratch)
    recipes = cut.select(
        "doc_id", "row", "points", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.transform("chunks", lambda c: _digest(c, digest_bits)).alias("recipe"),
    )
    if later is not None:
        recipes = _told_apart(recipes, cut, later, digest_bits)
    salt = F.pmod(F.xxhash64("doc_id", "points", "row"), F.lit(SALTS)).cast("int")
    with bounded_batches(docs.sparkSession):
        recipes = scratch.write(recipes.withColumn("salt", salt), "recipes")
    if later is not None:
        scratch.release(later)

    rank = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    parts = recipes.groupBy("recipe", "salt").agg(
        F.count(F.lit(1)).alias("rows"), F.min(rank).alias("best")
    )
    group = Window.partitionBy("recipe")  # a row per salt at most
    whole = parts.select(
        "recipe", "salt", F.sum("rows").over(group).alias("group_size"), F.min("best").over(group).alias("best")
    )
    joined = recipes.join(whole, ["recipe", "salt"])
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (-F.col("points") == F.col("best.p")) & (F.col("row") == F.col("best.row"))
    return joined.select(
        F.col("doc_id").alias(id_col), F.col("best.doc_id").alias("keep_id"), "group_size",
        same.alias("kept"), "text_sha256", *([F.col("row").alias(row_col)] if row_col else []),
    )


def _told_apart(recipes: DataFrame, cut: DataFrame, later: DataFrame, digest_bits: int) -> DataFrame:
    """Recipes with the numbers of those chunks that share a digest with an earlier content.

    The numbers follow the digests in the list, each after the place it belongs to.
    """
    placed = cut.select(
        "doc_id", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.posexplode("chunks").alias("place", "chunk"),
    ).withColumn("digest", _digest(F.col("chunk"), digest_bits))
    numbers = (
        placed.join(later, ["digest", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.sort_array(F.collect_set(F.struct(F.col("place").cast("long").alias("place"), F.col("number").cast("long").alias("number")))).alias("numbers"))
    )
    n = numbers.withColumnsRenamed({"doc_id": "_id", "text_sha256": "_sha"})
    found = recipes.join(n, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_sha256") == F.col("_sha")), "left")
    listed = F.flatten(F.transform("numbers", lambda x: F.array(x["place"], x["number"])))
    more = F.when(F.col("numbers").isNull(), F.array().cast("array<bigint>")).otherwise(F.concat(F.array(F.lit(-1).cast("bigint")), listed))
    return found.select("doc_id", "row", "points", "text_sha256", F.concat("recipe", more).alias("recipe"))


#: The same rows in SQL.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS nth, count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""

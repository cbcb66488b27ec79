"""Ordered work that survives hot keys.

A window partitioned by key puts all rows of a key in one task. The operators here cut the
sorted data into chunks of similar size instead, so a key with most of the rows spans many
chunks; what crosses a chunk border is patched from one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import stage

CHUNK = "_chunk"
OFFSET = "_offset"
_SPREAD = "_spread"
_ROW_BITS = 33
#: Rows of a chunk, which one task sorts and one window partition holds.
ROWS_PER_CHUNK = 2_000_000


def in_chunks(df: DataFrame, *order: str | Column, name: str = "chunks") -> DataFrame:
    """Range-partition and sort ``df``; adds the chunk number and the offset within the chunk.

    The number of chunks follows the number of rows, whatever the session's shuffle partitions are.
    The input is written first: counting it is then free, and the sampling of range borders does not
    evaluate it once more. The result is written too, because a chunk number must not change
    between uses. Chunk numbers follow the order.
    """
    held = stage(df, f"{name}_input")
    chunks = -(-held.count() // ROWS_PER_CHUNK)
    ranged = held.repartitionByRange(chunks, *order) if chunks > 1 else held.coalesce(1)
    number = F.monotonically_increasing_id()
    split = ranged.sortWithinPartitions(*order).withColumn(OFFSET, number).withColumns(
        {
            CHUNK: F.shiftright(F.col(OFFSET), _ROW_BITS),
            OFFSET: F.col(OFFSET).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    return stage(split, name)


def with_positions(df: DataFrame, *order: str | Column, into: str = "position") -> DataFrame:
    """Contiguous row numbers 1..N in the given order, without a single-task window.

    Only one row per chunk meets in a window: the start position of the chunk.
    """
    chunked = in_chunks(df, *order, name="positions")
    sizes = chunked.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    position = (F.col("_start") + F.col(OFFSET) + 1).cast("bigint")
    # one row per range partition, so the broadcast is bounded by the shuffle partition count
    return (
        chunked.join(F.broadcast(starts), CHUNK)
        .withColumn(into, position)
        .drop(CHUNK, OFFSET, "_start")
    )


def carried_forward(
    rows: DataFrame, key: str, order: list[str], payload: str, into: str
) -> DataFrame:
    """For every row the latest non-NULL ``payload`` of the same key at or before it.

    ``payload`` is a column (may be a struct) that is NULL on rows to be filled; the result has
    ``into`` in its place. The value kept from earlier chunks is one row per chunk.
    """
    pair = F.struct(F.col(key).alias("k"), F.col(payload).alias("v"))
    tagged = rows.withColumn("_tagged", F.when(F.col(payload).isNotNull(), pair)).drop(payload)
    # rows of one key and one moment may come in any order: a hash lets even those be divided
    spread = tagged.withColumn(_SPREAD, F.xxhash64(*tagged.columns))
    chunked = in_chunks(spread, key, *order, _SPREAD, name="carried").drop(_SPREAD)
    within = Window.partitionBy(CHUNK).orderBy(OFFSET)
    local = F.last("_tagged", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = chunked.groupBy(CHUNK).agg(
        F.max_by("_tagged", F.when(F.col("_tagged").isNotNull(), F.col(OFFSET))).alias("_end")
    )
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    brought = ends.select(CHUNK, F.last("_end", ignorenulls=True).over(before).alias("_brought"))
    found = F.coalesce(F.col("_local"), F.col("_brought"))
    return (
        chunked.withColumn("_local", local)
        .join(F.broadcast(brought), CHUNK)
        .withColumn(into, F.when(found["k"] == F.col(key), found["v"]))
        .drop(CHUNK, OFFSET, "_tagged", "_local", "_brought")
    )


def with_neighbours(
    rows: DataFrame, key: str, order: list[str], payload: list[str],
    previous: str = "previous", following: str = "following",
) -> DataFrame:
    """Adds structs of ``payload`` of the row before and after within the same key."""
    chunked = in_chunks(rows, key, *order, name="neighbours")
    content = F.struct(F.col(key).alias("_key"), *payload)
    within = Window.partitionBy(CHUNK).orderBy(OFFSET)
    edges = chunked.groupBy(CHUNK).agg(
        F.min_by(content, F.col(OFFSET)).alias("_first"),
        F.max_by(content, F.col(OFFSET)).alias("_last"),
    )
    across = Window.orderBy(CHUNK)
    edges = edges.select(
        CHUNK,
        F.lag("_last").over(across).alias("_from_before"),
        F.lead("_first").over(across).alias("_from_after"),
    )
    joined = (
        chunked.withColumn("_lag", F.lag(content).over(within))
        .withColumn("_lead", F.lead(content).over(within))
        .join(F.broadcast(edges), CHUNK)
    )
    before = F.coalesce("_lag", "_from_before")
    after = F.coalesce("_lead", "_from_after")

    def content_of(neighbour: Column) -> Column:
        same_key = neighbour["_key"] == F.col(key)
        return F.when(same_key, F.struct(*(neighbour[c].alias(c) for c in payload)))

    widened = joined.withColumns({previous: content_of(before), following: content_of(after)})
    return widened.drop(CHUNK, OFFSET, "_lag", "_lead", "_from_before", "_from_after")

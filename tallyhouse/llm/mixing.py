"""Mixing sources to target weights over a curriculum that changes with time.

How much of each source: sources share a total by weight, no source gives more than ``cap`` times its
size, and what is over is shared again by weight until none is above (the level at which it settles has
a closed form over sources sorted by cap and weight). A source's documents stand in an order drawn from
a hash of their ids, or of their texts where they have none. All of them are taken as many whole times as the target holds, and of the rest
those whose middle lies within it, so that a source ends within half a document of its target.

When: each source has a weight schedule, a piecewise linear function of training time (0 to 1). Its
integral, scaled to what the source gives, is the demand for its tokens up to a time. A document that
starts at c words of its source is due when the demand reaches the middle of its words; inverting the
integral, a quadratic on each piece, gives the position. Range-sorting by position gives the order of
training.

Scale: words are counted once. A source with a third of all rows is cut by the leading digits of the
hash into thousands of buckets; running sums go over bucket totals first and then within one bucket, so
no task holds a source. Sources themselves are one row each and are ranked in one small window. Schedules
are literals.

Defined results: a null text has size 0 and a document of size 0 is never taken. Null is a source of its
own, last in order. Rows that repeat a doc_id are documents of their own. An empty table gives an empty
result. The total is shared in full unless all sources are at their cap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, bounded_batches, whole_text, word_count

#: Weights of sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Hash digits that name a bucket: 16 ** 3 of them per source.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Schedule:
    """A weight over training time, linear from ``start`` to ``middle`` (at 0.5) to ``end``.

    Only its shape counts: it is scaled to what the source gives in all.
    """

    start: float
    middle: float
    end: float

    def __post_init__(self) -> None:
        if min(self.start, self.middle, self.end) < 0 or self.start + 2 * self.middle + self.end <= 0:
            raise ValueError("a schedule is nowhere negative and somewhere positive")

    @property
    def halves(self) -> tuple[float, float]:
        """The integral over each half."""
        return (self.start + self.middle) / 4, (self.middle + self.end) / 4


#: Schedules of sources in their order, repeating: early, even, late.
CURRICULUM = (Schedule(1.5, 1.0, 0.5), Schedule(1.0, 1.0, 1.0), Schedule(0.5, 1.0, 1.5))


def _time_within(low: float, high: float, area: Column) -> Column:
    """Where, in a half of length 0.5, the integral of a line from ``low`` to ``high`` is ``area``.

    The root is written with the square root in the denominator, which also holds for even lines.
    """
    slope = (high - low) / 0.5
    root = F.sqrt(F.greatest(F.lit(low * low) + F.lit(2 * slope) * area, F.lit(0.0)))
    bottom = F.lit(low) + root
    return F.when(bottom > 0, F.lit(2.0) * area / bottom).otherwise(F.lit(0.0))


def due_at(schedule: Schedule, share: Column) -> Column:
    """The time at which ``share`` (0 to 1) of a source's tokens is demanded."""
    first, second = schedule.halves
    area = share * F.lit(first + second)
    early = _time_within(schedule.start, schedule.middle, area)
    late = F.lit(0.5) + _time_within(schedule.middle, schedule.end, area - F.lit(first))
    return F.least(F.when(area <= F.lit(first), early).otherwise(late), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, cap: int = 2) -> DataFrame:
    """Adds ``place``, ``weight`` and ``target`` to one row per source with its ``source_size``."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("place", F.row_number().over(in_order) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight.cast("long")).withColumn("most", cap * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = placed.select(
        "*",
        (F.sum("source_size").over(everything) * percent - 100 * F.coalesce(F.sum("most").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("by"),
    )
    # with many sources the products pass a long
    wide = {name: F.col(name).cast("decimal(38,0)") for name in ("most", "by", "left", "weight")}
    capped = (F.lit(100).cast("decimal(38,0)") * wide["most"] * wide["by"] <= wide["left"] * wide["weight"]).cast("int")
    free = F.col("capped") == 0
    level = level.withColumn("capped", capped)
    # of the sources below their cap, the first has the whole rest before it
    level = level.select(
        "source", "source_size", "place", "weight", "most", "capped",
        F.max(F.when(free, F.col("left"))).over(everything).alias("left"),
        F.max(F.when(free, F.col("by"))).over(everything).alias("by"),
    )
    shared = F.col("weight") * F.col("left").cast("double") / (100 * F.col("by"))
    target = F.when(free, F.least(shared, F.col("most").cast("double"))).otherwise(F.col("most").cast("double"))
    return level.select("source", "source_size", "place", "weight", target.alias("target"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, percent: int = 150, cap: int = 2,
    curriculum: tuple[Schedule, ...] = CURRICULUM, row_col: str | None = None,
) -> DataFrame:
    """One row per document: id, size, ``source_size``, ``target``, ``passes``, ``taken`` and ``positions``.

    ``positions`` has the training time of each pass, earliest first. ``row_col`` names a column that tells rows
    apart (a long) and is then part of the result.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    row = F.col(row_col) if row_col else F.lit(0)
    # rows without an id are drawn by their text, so that they spread over the buckets
    drawn = F.coalesce(F.col(id_col).cast("string"), F.md5(whole_text(text_col).cast("binary")))
    digits = F.md5(drawn.cast("binary"))
    sizes = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        digits.alias("hash"), row.cast("long").alias("row"),
    )
    with bounded_batches(docs.sparkSession):
        rows = scratch.write(sizes.withColumn("bucket", F.substring("hash", 1, BUCKET_DIGITS)), "sizes")
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.withColumn("start", F.coalesce(F.sum("in_bucket").over(running), F.lit(0)))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, percent, cap)
    targets = scratch.write(targets.withColumnRenamed("source", "_source"), "targets")
    told = starts.join(targets, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), "start", "source_size", "target", "place"
    )
    met = rows.join(told, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    within = Window.partitionBy("source", "bucket").orderBy("hash", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = met.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    whole = F.least(F.lit(cap), F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("whole") < cap) & (2 * F.col("before") + F.col("size") <= 2 * rest)
    placed = placed.withColumn("whole", whole)
    passes = F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(F.lit(0).cast("long"))
    placed = placed.withColumn("passes", passes)
    middle = F.col("before") + F.col("size") / F.lit(2.0)
    demanded = F.greatest("target", (F.col("whole") * F.col("source_size")).cast("double"), F.lit(1.0))
    kinds = len(curriculum)

    def position(nth: Column) -> Column:
        share = F.least((nth * F.col("source_size") + middle) / demanded, F.lit(1.0))
        result = due_at(curriculum[-1], share)
        for i in range(kinds - 1):
            result = F.when(F.col("place") % kinds == i, due_at(curriculum[i], share)).otherwise(result)
        return result

    every = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1), position))
    return placed.select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", "passes",
        (F.col("passes") * F.col("size")).alias("taken"),
        F.coalesce(every, F.array().cast("array<double>")).alias("positions"),
        *([F.col("row").alias(row_col)] if row_col else []),
    )


def training_order(mixed: DataFrame, *order: str) -> DataFrame:
    """One row per pass of a document, range-sorted by ``position``."""
    passes = mixed.select("*", F.posexplode("positions").alias("pass", "position")).drop("positions")
    return passes.repartitionByRange("position", *order).sortWithinPartitions("position", *order)


#: The same amounts and positions in SQL. A source demands ``due`` words in all, of which a share is due at a time.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS hash,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS most, CAST([5, 2, 1][CAST(place % 3 AS INTEGER) + 1] AS BIGINT) AS weight FROM s),
l AS (
  SELECT *, CAST(150 * sum(source_size) OVER () - 100 * coalesce(sum(most) OVER b, 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS shares
  FROM w WINDOW b AS (ORDER BY CAST(most AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CAST(100 AS HUGEINT) * most * shares <= CAST(rest AS HUGEINT) * weight AS capped FROM l),
t AS (
  SELECT source, source_size, place, most, capped, weight,
         max(rest) FILTER (NOT capped) OVER () AS rest, max(shares) FILTER (NOT capped) OVER () AS shares FROM c),
g AS (
  SELECT source, source_size, place,
         CASE WHEN capped THEN CAST(most AS DOUBLE)
              ELSE least(weight * CAST(rest AS DOUBLE) / (100 * shares), CAST(most AS DOUBLE)) END AS target FROM t),
p AS (
  SELECT d.*, source_size, target, place, CAST(least(2, floor(target / greatest(source_size, 1))) AS BIGINT) AS whole,
         CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY hash, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE whole + CAST(whole < 2
    AND 2 * before + size <= 2 * (target - whole * source_size) AS BIGINT) END AS passes FROM p),
v AS (SELECT unnest([0, 1, 2]) AS kind, unnest([1.5, 1.0, 0.5]::DOUBLE[]) AS a, unnest([1.0, 1.0, 1.0]::DOUBLE[]) AS b, unnest([0.5, 1.0, 1.5]::DOUBLE[]) AS c),
h AS (
  SELECT q.*, a, b, c, (a + b) / 4 AS early, (a + b) / 4 + (b + c) / 4 AS whole_area, before + size / 2.0::DOUBLE AS middle,
         greatest(target, CAST(whole * source_size AS DOUBLE), 1.0::DOUBLE) AS due
  FROM q JOIN v ON place % 3 = kind),
e AS (
  SELECT *, least(middle / due, 1.0) * whole_area AS area1, least(((passes - 1) * source_size + middle) / due, 1.0) * whole_area AS area2
  FROM h),
r AS (
  SELECT *,
    least(CASE WHEN area1 <= early THEN 2.0 * area1 / (a + sqrt(greatest(a * a + 2 * ((b - a) / 0.5) * area1, 0.0)))
      ELSE 0.5 + 2.0 * (area1 - early) / (b + sqrt(greatest(b * b + 2 * ((c - b) / 0.5) * (area1 - early), 0.0))) END, 1.0) AS p1,
    least(CASE WHEN area2 <= early THEN 2.0 * area2 / (a + sqrt(greatest(a * a + 2 * ((b - a) / 0.5) * area2, 0.0)))
      ELSE 0.5 + 2.0 * (area2 - early) / (b + sqrt(greatest(b * b + 2 * ((c - b) / 0.5) * (area2 - early), 0.0))) END, 1.0) AS p2
  FROM e)
SELECT doc_id, size, source_size, target, passes, passes * size AS taken,
       CASE WHEN passes > 0 THEN p1 END AS first_position, CASE WHEN passes > 0 THEN p2 END AS last_position FROM r
"""

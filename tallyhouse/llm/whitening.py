"""Whitening of embeddings by a covariance over distinct vectors and their multiplicities.

Entries are brought to whole numbers, x = floor(scale * c) + offset, so equal vectors are exactly equal.
Identical x vectors are one group with the number of rows that share it. Everything costly works on groups:
a weighted centred matrix product per block gives the covariance (the weight is the group's count, or one),
its eigenvectors are found once on the driver from a table of dimension x dimension numbers, each distinct
vector is whitened once, and rows get the result of their group by a join.

Scale: tasks stream over blocks of groups and give one small matrix each, whose rows are added by row number
across tasks, in the order of the tasks. A group that holds more than a thousandth of all rows would
be a hot key of the join; there are fewer than a thousand of these, which bounds the broadcast that serves
them, and every other key of the shuffled join has few rows. Sums and deviations are exact whole numbers.

Defined results: vectors that are null, empty, or hold a null or a component that is not finite are dropped.
Vectors of the commonest length (the longest of several) are whitened; others have no common covariance with
them and are dropped. Components with an eigenvalue below ``LEAST`` of the trace have no spread to divide
by and no row, so one vector alone, or equal ones, give an empty result, as does an empty table. Rows that
repeat an id, or have none, are rows of their own. A deviation beyond a long is null in ``deviation`` and
exact in ``deviation_exact`` (null beyond 38 digits). Entries beyond 2 ** 62 count as that. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, quoted

SCALE, OFFSET = 64, 1_000_000
#: Least eigenvalue of a component, as a share of the trace.
LEAST = 1e-12
#: A group with more than this share of the rows is served by broadcast.
HOT_SHARE = 1000
#: Numbers of one block of vectors in a task.
BLOCK_NUMBERS = 1 << 20
_FAR = 1 << 62


@dataclass(frozen=True)
class Whitener:
    """What is known of the fit list: its length, sums, and the components by falling eigenvalue."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()


def whole_numbers(vector: Column) -> Column:
    """x = floor(SCALE * c) + OFFSET of every entry."""

    def number(c: Column) -> Column:
        scaled = F.lit(float(SCALE)) * c.cast("double")
        return F.greatest(F.least(F.floor(F.greatest(F.least(scaled, F.lit(2.0**62)), F.lit(-(2.0**62)))), F.lit(_FAR)), F.lit(-_FAR)) + F.lit(OFFSET)

    return F.transform(vector, number)


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them finite numbers."""
    far = F.lit(float("inf"))
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < far))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _blocks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of bounded size, with the vectors of their first column."""
    step = max(1, BLOCK_NUMBERS // length)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, _matrix(part.column(0), length)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: long where that holds, Python's whole numbers where not."""
    furthest = max(int(x.max()), -int(x.min()), max(map(abs, sums)) // n + 1)
    if 2 * n * furthest < _FAR:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviations(offsets: np.ndarray) -> list[int]:
    """Sum of squares per row, exactly."""
    if offsets.dtype != object and float(np.abs(offsets).max()) ** 2 * offsets.shape[1] < _FAR:
        return (offsets * offsets).sum(1).tolist()
    whole = offsets.astype(object)
    return (whole * whole).sum(1).tolist()


def _sums(groups: DataFrame, length: int) -> tuple[int, list[int]]:
    """Sum of weights, and exact weighted sums per dimension, of (x, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(length, object), 0
        for part, x in _blocks(batches, length):
            weight = part.column(1).to_numpy()
            n += int(weight.sum())
            small = float(np.abs(x).max()) * float(weight.sum()) < _FAR
            total = total + (weight @ x if small else weight.astype(object) @ x.astype(object)).astype(object)
        rows = [[Decimal(int(v)) for v in (n, *total)]]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.decimal128(38, 0)))], ["v"])

    partial = groups.select("x", "weight").mapInArrow(run, "v array<decimal(38,0)>")
    summed = partial.select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    found = {r["i"]: int(r["v"]) for r in summed.collect()}  # a row per dimension
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(length)]


def _add_rows(partial: DataFrame, length: int) -> np.ndarray:
    """Adds the rows (i, part, v) of the tasks' matrices by i, in the order of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), length), strict=True):
                held[i] = held[i] + row if i in held else row
        rows = pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), rows], ["i", "v"])

    together = partial.repartition("i").sortWithinPartitions("i", "part").select("i", "v").mapInArrow(run, "i int, v array<double>")
    result = np.zeros((length, length))
    for row in together.collect():  # dimension x dimension numbers
        result[row["i"]] = row["v"]
    return result


def covariance(rows: DataFrame, length: int, n: int, centred: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Weighted covariance of (vector, weight), divisor ``n``; ``centred`` takes the mean off a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for part, x in _blocks(batches, length):
            c = centred(x)
            total += c.T @ (c * part.column(1).to_numpy()[:, None])
        cells = [
            pa.array(range(length), pa.int32()),
            pa.array([TaskContext.get().partitionId()] * length, pa.int32()),
            pa.array(total.tolist(), pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(cells, ["i", "part", "v"])

    return _add_rows(rows.mapInArrow(run, "i int, part int, v array<double>"), length) / n


def fit(groups: DataFrame, length: int, components: int) -> Whitener | None:
    """The components of (x, weight); None where nothing is there or nothing differs."""
    n, sums = _sums(groups, length)
    if n == 0:
        return None
    v = covariance(groups.select("x", "weight"), length, n, lambda x: (_offsets(x, n, sums) / n).astype(np.float64))
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(v))
    order = order[values[order] > LEAST * trace] if trace > 0 else order[:0]
    if not len(order):
        return None
    chosen = vectors[:, order]
    largest = chosen[np.abs(chosen).argmax(0), np.arange(len(order))]
    return Whitener(n, sums, trace, values[order], chosen * np.where(largest < 0, -1.0, 1.0))


def whitened_groups(groups: DataFrame, length: int, model: Whitener) -> DataFrame:
    """(x, weight, whitened, deviation_exact) of every distinct vector."""
    n, sums = model.n, model.sums
    towards = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, length):
            offsets = _offsets(x, n, sums)
            white = (offsets / n).astype(np.float64) @ towards
            exact = [Decimal(d) if d < 10**38 else None for d in map(int, _deviations(offsets))]
            columns = [*part.columns, pa.array(list(white), pa.list_(pa.float64())), pa.array(exact, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["x", "rows", "weight", "whitened", "deviation_exact"])

    schema = "x array<long>, rows long, weight long, whitened array<double>, deviation_exact decimal(38,0)"
    return groups.select("x", "rows", "weight").mapInArrow(run, schema)


def identity_error(whitened: DataFrame, kept: int, n: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kept)
        for part, x in _blocks(batches, kept):
            total += part.column(1).to_numpy() @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(kept), pa.int32()), pa.array(total)], ["i", "v"])

    rows = whitened.select("whitened", "weight")
    summed = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # a row per component
    mean = np.zeros(kept)
    for row in summed:
        mean[row["i"]] = row["v"] / n
    return float(np.abs(covariance(rows, kept, n, lambda x: x - mean) - np.eye(kept)).max())


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
)


def whiten(
    embeddings: DataFrame, components: int = 32, weights: str = "counts", id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per kept vector and component. ``weights`` is "counts" (the fit list is all rows) or "ones" (all
    distinct vectors)."""
    if weights not in ("counts", "ones"):
        raise ValueError("weights are counts or ones")
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "whitening")
    given = embeddings.select(F.col(quoted(id_col)).cast("long").alias("vec_id"), F.col(quoted(vec_col)).alias("v")).filter(usable(F.col("v")))
    lengths = given.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length"))
    commonest = lengths.first()
    if commonest is None:
        return spark.createDataFrame([], RESULT)
    length = commonest["length"]
    rows = given.filter(F.size("v") == length).select("vec_id", whole_numbers(F.col("v")).alias("x"))
    counted = rows.groupBy("x").agg(F.count("*").alias("rows"))
    groups = scratch.write(counted.withColumn("weight", F.col("rows") if weights == "counts" else F.lit(1).cast("long")), "groups")
    model = fit(groups, length, components)
    if model is None:
        scratch.release(groups)
        return spark.createDataFrame([], RESULT)
    white = scratch.write(whitened_groups(groups, length, model), "whitened")
    scratch.release(groups)
    error = identity_error(white, len(model.values), model.n)
    # fewer than HOT_SHARE groups can hold more than 1 / HOT_SHARE of the rows
    is_hot = F.col("rows") > commonest["count"] // HOT_SHARE
    told = white.select("x", "whitened", "deviation_exact", "rows")
    hot = F.broadcast(told.filter(is_hot))
    others = rows.join(F.broadcast(told.filter(is_hot).select("x")), "x", "left_anti")
    joined = rows.join(hot, "x").unionByName(others.join(told.filter(~is_hot), "x"))
    most = F.lit(Decimal(2**63 - 1))
    deviation = F.when(F.col("deviation_exact") <= most, F.col("deviation_exact").cast("long"))
    each = joined.select(
        "vec_id", F.posexplode("whitened").alias("at", "whitened"), deviation.alias("deviation"), "deviation_exact"
    )
    explained = F.element_at(F.array(*map(F.lit, model.explained)), F.col("at") + 1)
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact",
    )

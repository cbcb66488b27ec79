"""Nearest neighbours by a block matrix join.

Vectors are scaled to length 1 and rounded to int8 with a scale of their own; the length of what rounding
lost is known exactly. Queries and candidates are cut into blocks, and every two blocks meet as one tile. The
product of the int8 tiles gives each cosine up to the sum of both losses, so most pairs are settled by
bounds: a pair goes on only if its upper bound reaches the k-th best lower bound of its query. What goes
on is computed again in double precision from the original vectors, a tile keeps the k best per query,
and a heap merges the tiles.

A tile streams over its candidates and holds one block of queries; of identical vectors in a batch only
the k with the smallest ids but the query's own can be among the k nearest, and 2 k rows hold these, so a vector that a third of all rows share
costs no more than others. All queries meet all candidates; the result is exact.

Defined results: vectors that are null, zero, or hold a null or a component that is not finite take no part,
as query or candidate; nor do rows without an id. Only vectors of equal length are compared. Rows with the
query's own id are no candidates; other rows that repeat an id count each for itself. Queries of equal
id and vector are one; an id with several vectors has ranks for each. A query without
candidates has no row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 16_384
#: Candidates per product, so that a product of one block of queries stays near 16 MB.
STEP = 2048
#: Pairs computed in double precision at a time.
PAIRS = 1 << 17


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the vectors at length 1, their scales, and the lengths of what rounding lost."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
    scales = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    lost = unit - codes * scales[:, None]
    return codes, scales, np.sqrt((lost * lost).sum(1))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest component near 1; cosines stay as they are."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    return np.ldexp(vectors, -exponent[:, None])


def cosines(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, summed component by component, whatever the batch."""
    dot, a, b = np.zeros(len(some)), np.zeros(len(some)), np.zeros(len(some))
    for i in range(some.shape[1]):
        x, y = some[:, i], other[:, i]
        dot += x * y
        a += x * x
        b += y * y
    return np.clip(dot / np.sqrt(a * b), -1.0, 1.0)


class _Tile:
    """One block of queries and the best found so far for each."""

    def __init__(self, ids: np.ndarray, keys: list[int], vectors: np.ndarray, k: int) -> None:
        self.ids, self.keys, self.vectors, self.k = ids, keys, vectors, k
        codes, self.scales, self.lost = quantised(vectors)
        self.codes = codes.astype(np.float32)  # products of int8 are exact sums in float up to 2 ** 24
        self.exact = vectors.shape[1] * 127 * 127 < 1 << 24
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]  # heaps of (score, -id)
        self.floor = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        ids, vectors = _smallest_of_equal(ids, vectors, self.k)
        codes, scales, lost = quantised(vectors)
        kind = np.float32 if self.exact else np.float64
        product = self.codes.astype(kind, copy=False) @ codes.astype(kind).T
        near = product.astype(np.float64) * (self.scales[:, None] * scales[None, :])
        # a code vector is at most 1 + its loss long; the last term covers rounding of this very sum
        slack = self.lost[:, None] + (1 + self.lost[:, None]) * lost[None, :] + 1e-9
        own = self.ids[:, None] == ids[None, :]
        near[own] = -np.inf  # however often the query's id is there, it counts for nothing
        floor = self.floor
        if len(ids) >= self.k:
            floor = np.maximum(floor, np.partition(near - slack, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        q, c = np.nonzero((near + slack >= floor[:, None]) & ~own)
        for at in range(0, len(q), PAIRS):
            some, other = q[at : at + PAIRS], c[at : at + PAIRS]
            score = cosines(self.vectors[some], vectors[other])
            for i, value, name in zip(some.tolist(), score.tolist(), ids[other].tolist(), strict=True):
                heap, entry = self.best[i], (value, -name)
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        self.floor = np.array([h[0][0] if len(h) == self.k else -np.inf for h in self.best])

    def rows(self) -> pa.RecordBatch:
        queries = zip(self.ids.tolist(), self.keys, self.best, strict=True)
        found = [(q, key, -name, score) for q, key, heap in queries for score, name in heap]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        cells = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(cells, ["query_id", "key", "vec_id", "score"])


def _smallest_of_equal(ids: np.ndarray, vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set of identical vectors, enough for any query to find the ``most`` with the smallest ids but its own.

    Of one id ``most`` rows suffice, and then a query's own id has no more than these among the first.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    _, kind = np.unique(vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_inverse=True)
    by_kind = np.argsort(kind, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(kind[by_kind]) != 0])
    sorted_ids = ids[by_kind]
    runs = np.flatnonzero(np.r_[True, (np.diff(kind[by_kind]) != 0) | (np.diff(sorted_ids) != 0)])
    of_id = np.arange(len(ids)) - np.repeat(runs, np.diff(np.r_[runs, len(ids)]))
    few = of_id < most
    nth = np.cumsum(few) - few  # rows kept before, of any vector
    nth -= np.repeat(nth[starts], np.diff(np.r_[starts, len(ids)]))
    keep = np.sort(by_kind[few & (nth < 2 * most)])
    return ids[keep], vectors[keep]


def _vectors(cells: list[bytes], size: int) -> np.ndarray:
    return scaled(np.frombuffer(b"".join(cells), "<f8").reshape(-1, size).copy())


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, size, vector packed as doubles) of vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array(x, "<f8") for x in batch.column(1).to_pylist()]
            keep = [bool(np.isfinite(x).all() and x.any()) for x in found]
            names = batch.column(0).filter(pa.array(keep, pa.bool_()))
            kept = [x for x, ok in zip(found, keep, strict=True) if ok]
            cells = [names, pa.array([len(x) for x in kept], pa.int32()), pa.array([x.tobytes() for x in kept], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, ["vec_id", "size", "vector"])

    whole = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = whole.filter("vec_id IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL)")
    return whole.mapInArrow(run, "vec_id long, size int, vector binary")


def nearest(
    embeddings: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` nearest; ties go to the smaller id.

    ``queries`` is a condition on ``vec_id``.
    """
    scratch = Scratch(embeddings.sparkSession, "nearest")
    usable = scratch.write(_usable(embeddings, id_col, vector_col), "vectors")
    sizes = usable.agg(F.count(F.lit(1)).alias("all"), F.count_if(queries).alias("some")).head()
    q_blocks = max(1, -(-sizes["some"] // query_block))
    c_blocks = max(1, -(-sizes["all"] // candidate_block))
    own = F.xxhash64("vec_id", "vector")

    def block(n: int) -> Column:
        return F.pmod(own, F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # repeated rows ask once; an id with several vectors asks with each
    asked = usable.filter(queries).dropDuplicates(["vec_id", "vector"]).select("*", block(q_blocks).alias("q"), every(c_blocks).alias("c"), F.lit(0).alias("side"))
    there = usable.select("*", every(q_blocks).alias("q"), block(c_blocks).alias("c"), F.lit(1).alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, tile, names, keys, cells, side, size = None, None, [], [], [], 0, 0

        def take() -> None:
            nonlocal tile, names, keys, cells
            if names:
                ids, vectors = np.array(names, np.int64), _vectors(cells, size)
                if side == 0:
                    tile = _Tile(ids, keys, vectors, k)
                elif tile is not None:
                    tile.meet(ids, vectors)
            names, keys, cells = [], [], []

        for batch in batches:
            for *key, next_side, name, own_key, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != unit:
                    take()
                    if tile is not None:
                        yield tile.rows()
                    unit, tile, side, size = key, None, 0, key[2]
                if next_side != side:
                    take()
                    side = next_side
                elif side == 1 and len(names) == STEP:
                    take()
                names.append(name)
                keys.append(own_key)
                cells.append(vector)
        take()
        if tile is not None:
            yield tile.rows()

    tiles = asked.union(there).select("q", "c", "size", "side", "vec_id", own.alias("key"), "vector").repartition("q", "c", "size")
    ordered = tiles.sortWithinPartitions("q", "c", "size", "side", "vec_id")
    partly = ordered.mapInArrow(run, "query_id long, key long, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, vector, heap = None, None, []

        def rows() -> pa.RecordBatch:
            best = heapq.nsmallest(k, heap)
            cells = [[query] * len(best), range(1, len(best) + 1), [x[1] for x in best], [-x[0] for x in best]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(x), kind) for x, kind in zip(cells, kinds, strict=True)], ["query_id", "rank", "vec_id", "score"]
            )

        for batch in batches:
            for name, key, other, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query is not None and (name, key) != (query, vector):
                    yield rows()
                    heap = []
                query, vector = name, key
                heap.append((-score, other))
        if heap:
            yield rows()

    by_query = partly.repartition("query_id").sortWithinPartitions("query_id", "key")
    return by_query.mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


#: The same rows in SQL: all pairs.
ORACLE = r"""
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""

"""Near-duplicate join on word shingles: documents link when the Jaccard similarity of their shingle sets
reaches a threshold.

Method: T-occurrence search over an inverted index, by DivideSkip. Equal sets are one class. A class of n
shingles shares at least T = ceil(threshold * n) of them with a partner.

1. Index. One pass over the texts sends each class's shingles, as packed numbers, to parts of the shingle
   space. A part counts in how many classes each shingle occurs, and only shingles in two or more go
   on: one that occurs once cannot be shared, and what a class keeps still gives every overlap exactly.
   Classes that keep fewer than T shingles have no partner and leave.
2. Order. All classes sort their shingles by length of list. Partners meet in a list that is not among
   the T - 1 longest of either; these short lists are all that classes are sent to.
3. First search. A class merges what its short lists offer, from each the list's first class, and probes
   the set of the one offered most often. Links are contracted to components. This takes
   linear work and turns a group of thousands of near copies into one component.
4. Full search. Lists that still hold several components bring their classes together: classes connected by
   such lists are one family, a family is cut into blocks (a large component into blocks of its own), and
   every two blocks that a list connects, unless they hold one component, meet in one task. It builds their inverted lists and runs DivideSkip for each class: heap-merge of the
   short lists with counts, then binary probes of the long lists for those that can still reach the
   overlap. Only classes of different components are compared, and a task returns only links that join
   components, so that its output stays linear.

Nothing grows with the square of a list: a list's members, not their pairs, are rows. Tables between the steps
are written to the shared folder.

Shingles are 56-bit hashes of word sequences, of which 48 bits and the part's number take part in
comparisons; counts and overlaps are exact up to a collision of these within two compared documents (for
10,000 words each about 1 in 10^8 with 64 parts).

Defined results: null, empty and blank texts have no shingle and are linked with nothing. A text of fewer
words than a shingle is one shingle, its whole sequence. Rows that repeat a doc_id are documents of that
name; the result has one row per row of the input. A null doc_id names a component only if all its documents
have it. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, bounded_batches, whole_text
from tallyhouse.llm.components import components

#: Distinct words whose hashes a worker remembers.
CACHE_WORDS = 200_000
#: Shingles a task gathers before it sends them off.
BATCH_SHINGLES = 500_000
#: Classes of a block in the full search.
BLOCK = 128
#: Blocks of a list, or meetings of a block, that one salt takes.
LIST_BLOCKS = 256
SALTS = 64
#: Weight of the longest list in DivideSkip's choice of how many lists to probe.
DIVIDE = 0.0085

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class _WordHashes:
    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            missing = [w for w in set(words) if w not in known]
        if len(known) + len(missing) > CACHE_WORDS:
            known.clear()
            missing = list(set(words))
        known.update((w, xxhash.xxh64_intdigest(w)) for w in missing)
        return np.array([known[w] for w in words], np.uint64)


@cache
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``width`` words, A-Z lower-cased."""
    words = text.lower().split()  # bytes: only ASCII letters and ASCII white space count
    if not words:
        return np.empty(0, np.uint64)
    hashes = _word_hashes()(words)
    width = min(width, len(words))
    rows = len(words) - width + 1
    mixed = np.full(rows, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + rows]) * _MIX[0]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIX[1]
    return np.unique(mixed >> np.uint64(8))


# --- 1. index -------------------------------------------------------------------------------------

_ROWS = "doc_id long, class long, n long, part int, classes binary, sizes binary, counts binary, hashes binary, row long"
_NAMES = ["doc_id", "class", "n", "part", "classes", "sizes", "counts", "hashes", "row"]
_BITS = 56
#: Bytes sent of a shingle: what its part's number does not tell, at 256 parts; with fewer parts, a
#: shingle is that many bits shorter from here on.
_SENT = 6


def _parts_of(spark) -> int:
    """Parts of the shingle space: a power of two, at least the session's shuffle partitions."""
    return 1 << min(16, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def _class_name(found: np.ndarray) -> int:
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _packed(held: dict[int, np.ndarray], parts: int) -> pa.RecordBatch:
    """One row per part: which classes (with sizes) have how many shingles there, and the shingles."""
    names, sizes = np.fromiter(held, np.int64), np.array([len(x) for x in held.values()], np.uint32)
    every = np.concatenate(list(held.values()))
    owner = np.repeat(np.arange(len(names)), sizes)
    part = every >> np.uint64(_BITS - (parts.bit_length() - 1))
    order = np.argsort(part, kind="stable")
    every, owner = every[order], owner[order]
    borders = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    columns: list[list] = [[] for _ in range(5)]
    for p, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
        if a == b:
            continue
        met, count = np.unique(owner[a:b], return_counts=True)
        hashes = every[a:b].view(np.uint8).reshape(-1, 8)[:, :_SENT]
        row = (p, names[met].tobytes(), sizes[met].tobytes(), count.astype(np.uint32).tobytes(), hashes.tobytes())
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    none = pa.nulls(len(columns[0]), pa.int64())
    packed = [pa.array(columns[0], pa.int32()), *(pa.array(x, pa.binary()) for x in columns[1:])]
    return pa.RecordBatch.from_arrays([none, none, none, *packed, none], _NAMES)


def _described(
    docs: DataFrame, id_col: str, text_col: str, width: int, parts: int, row_col: str | None = None
) -> DataFrame:
    """Rows of two kinds from one pass over the texts: documents, and packed shingles by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = batch.slice(at, 200)
                names, counts = [], []
                for text in rows.column(1).cast(pa.binary()).to_pylist():
                    found = shingles(text, width)
                    name = _class_name(found) if len(found) else None
                    names.append(name)
                    counts.append(len(found))
                    if name is not None and name not in held:
                        held[name] = found
                        size += len(found)
                none = [pa.nulls(len(names), kind) for kind in (pa.int32(), *[pa.binary()] * 4)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(names, pa.int64()), pa.array(counts, pa.int64()), *none, rows.column(2)], _NAMES
                )
                if size >= BATCH_SHINGLES:
                    yield _packed(held, parts)
                    held, size = {}, 0
        if held:
            yield _packed(held, parts)

    row = (F.col(row_col) if row_col else F.lit(0)).cast("long").alias("row")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"), row)
    return rows.mapInArrow(run, _ROWS)


_SHARED = "doc_id long, class long, n long, bucket int, classes binary, sizes binary, hashes binary, lists binary, row long"
_SHARED_NAMES = ["doc_id", "class", "n", "bucket", "classes", "sizes", "hashes", "lists", "row"]


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(values):
        return np.empty(0, np.intp)
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]])


def _shared(described: DataFrame, buckets: int) -> DataFrame:
    """The shingles that two classes or more have, with the lengths of their lists, by bucket of classes.

    Rows that describe documents pass through, so that the shingles need not be written for a second use.
    """

    def counted(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        owner, size, every = (np.concatenate(x) for x in zip(*pieces, strict=True))
        order = np.lexsort((owner, every))
        owner, size, every = owner[order], size[order], every[order]
        new = np.ones(len(every), bool)  # several tasks may have met a class
        new[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
        owner, size, every = owner[new], size[new], every[new]
        length = np.diff(np.r_[_starts(every), len(every)])
        lists = np.repeat(length, length).astype(np.uint32)
        keep = lists > 1
        owner, size, every, lists = owner[keep], size[keep], every[keep], lists[keep]
        if not len(owner):
            return
        bucket = (owner.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        starts = _starts(bucket[order])
        for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
            rows = order[a:b]
            cells = [[None]] * 3 + [[bucket[rows[0]]]] + [[x[rows].tobytes()] for x in (owner, size, every, lists)] + [[None]]
            kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.binary()] * 4 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(cells, kinds, strict=True)], _SHARED_NAMES
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pieces = None, []
        for batch in batches:
            documents = pc.is_null(batch.column(3))
            texts = batch.filter(documents)
            if texts.num_rows:
                yield pa.RecordBatch.from_arrays(texts.columns, _SHARED_NAMES)
            batch = batch.filter(pc.invert(documents))
            for i in range(batch.num_rows):
                p, names, sizes, counts, raw = (c[i].as_py() for c in batch.columns[3:8])
                if part is not None and p != part:
                    yield from counted(pieces)
                    pieces = []
                part = p
                counts = np.frombuffer(counts, np.uint32)
                hashes = np.zeros((len(raw) // _SENT, 8), np.uint8)
                hashes[:, :_SENT] = np.frombuffer(raw, np.uint8).reshape(-1, _SENT)
                owners = np.repeat(np.frombuffer(names, np.int64), counts)
                pieces.append((owners, np.repeat(np.frombuffer(sizes, np.uint32), counts), hashes.view(np.uint64).ravel() | np.uint64(p << 8 * _SENT)))
        if pieces:
            yield from counted(pieces)

    spread = F.coalesce("part", F.pmod(F.xxhash64("doc_id", "row"), F.lit(buckets)).cast("int"))
    return described.repartition(spread).sortWithinPartitions("part").mapInArrow(run, _SHARED)


def _index(shared: DataFrame, percent: int) -> DataFrame:
    """(class, n, by_value, short): a class's shared shingles in order of value, and those of its short lists.

    Only classes that keep enough shingles for a partner are there.
    """

    def gathered(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        owner, size, every, lists = (np.concatenate(x) for x in zip(*pieces, strict=True))
        order = np.lexsort((every, lists, owner))
        owner, size, every = owner[order], size[order], every[order]
        starts = _starts(owner)
        rows: list[tuple] = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(owner)], strict=True):
            n = int(size[a])
            short = b - a - least(n, percent) + 1
            if short > 0:
                rows.append((int(owner[a]), n, np.sort(every[a:b]).tobytes(), every[a : a + short].tobytes()))
        for at in range(0, len(rows), 200):
            cells = zip(*rows[at : at + 200], strict=True)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(cells, kinds, strict=True)],
                ["class", "n", "by_value", "short"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, pieces = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                b, *cells = (c[i].as_py() for c in batch.columns)
                if bucket is not None and b != bucket:
                    yield from gathered(pieces)
                    pieces = []
                bucket = b
                kinds = (np.int64, np.uint32, np.uint64, np.uint32)
                pieces.append(tuple(np.frombuffer(x, kind) for x, kind in zip(cells, kinds, strict=True)))
        if pieces:
            yield from gathered(pieces)

    by_bucket = shared.select("bucket", "classes", "sizes", "hashes", "lists").repartition("bucket").sortWithinPartitions("bucket")
    return by_bucket.mapInArrow(run, "class long, n long, by_value binary, short binary")


# --- 2. and 3. short lists and first search -----------------------------------------------------------


def _postings(index: DataFrame) -> DataFrame:
    """(shingle, class) of all short lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            if found:
                names = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(names)], ["shingle", "class"])

    return index.select("class", "short").mapInArrow(run, "shingle long, class long")


def least(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` at least shares with a partner."""
    return -(-n * percent // 100)


def needed(n: int, m: int, percent: int) -> int:
    """Shingles that sets of ``n`` and ``m`` must share: 100 * shared >= percent * (n + m - shared)."""
    return -(-percent * (n + m) // (100 + percent))


def _first_links(index: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of classes with the class that most of their short lists offer."""
    first = postings.groupBy("shingle").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("list"))
    first = first.filter("list > 1").drop("list")
    offered = postings.join(first, "shingle").filter("class <> first")
    counts = offered.groupBy("class", "first").agg(F.count(F.lit(1)).alias("times"))
    best = counts.groupBy("class").agg(F.max_by("first", F.col("times") * F.lit(2.0) ** 20 + F.pmod("first", F.lit(1 << 20))).alias("first"))
    sets = index.select("class", "n", "by_value")
    # a class may be offered to a third of all others: its set is copied over salts
    salted = best.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int"))
    wanted = salted.select("first", "salt").distinct()
    firsts = sets.withColumnsRenamed({"class": "first", "n": "m", "by_value": "other"}).join(wanted, "first")
    pairs = salted.join(sets, "class").join(firsts, ["first", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, firsts, ns, ms, mine, others = (c.to_pylist() for c in batch.columns)
            linked = [
                shares(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= needed(n, m, percent)
                for x, y, n, m in zip(mine, others, ns, ms, strict=True)
            ]
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return pairs.select("class", "first", "n", "m", "by_value", "other").mapInArrow(run, "a long, b long")


def shares(some: np.ndarray, other: np.ndarray) -> int:
    """Common values of two sorted arrays of distinct values, by binary probes."""
    if len(some) > len(other):
        some, other = other, some
    if not len(some):
        return 0
    places = np.minimum(np.searchsorted(other, some), len(other) - 1)
    return int((other[places] == some).sum())


# --- 4. full search -----------------------------------------------------------------------------------


def divide_skip(
    lists: list[list[int]], need: int, accept
) -> list[int]:
    """Members of at least ``need`` of the sorted ``lists``, of those that ``accept`` lets pass.

    The longest lists are set aside; the others are merged with a heap, and members that occur often enough
    there are looked for in the long ones by binary search. ``need`` may be lowered by the caller to
    hold for every member; ``accept(member)`` gives the member's own need, or None to leave it out.
    """
    lists = sorted(filter(None, lists), key=len)
    if len(lists) < need:
        return []
    longest = len(lists[-1])
    long = min(need - 1, int(need / (DIVIDE * np.log2(longest + 1) + 1)))
    short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
    found = []
    for member, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < need - long:
            continue
        own = accept(member)
        if own is None or count + long < own:
            continue
        for left, entries in zip(range(long, 0, -1), probed, strict=True):
            if count >= own or count + left < own:
                break
            place = bisect_left(entries, member)
            count += place < len(entries) and entries[place] == member
        if count >= own:
            found.append(member)
    return found


def joins(classes: list[tuple[int, int, int, bytes, int]], percent: int) -> list[tuple[int, int]]:
    """Links that join components: ``classes`` has (class, component, n, packed shingles, side).

    With two sides, classes of one side are compared with those of the other; they were compared among
    themselves where their block met itself. Classes stand in order of size, so that a partner is no larger.
    """
    classes = sorted(classes, key=lambda c: (c[2], c[0]))
    sides = {c[4] for c in classes}
    root = {c[1]: c[1] for c in classes}

    def component(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    inverted: list[dict[int, list[int]]] = [{}, {}]
    links = []
    for i, (name, own, n, packed, side) in enumerate(classes):
        mine = np.frombuffer(packed, np.uint64).tolist()
        smallest = least(n, percent)  # of a partner, and of what it shares
        across = inverted[1 - side if len(sides) == 2 else side]
        lists = [across[x] for x in mine if x in across]

        def accept(j: int) -> int | None:
            other = classes[j]
            if other[2] < smallest or component(other[1]) == component(own):
                return None
            return needed(n, other[2], percent)

        for j in divide_skip(lists, smallest, accept):
            if component(classes[j][1]) != component(own):
                links.append((name, classes[j][0]))
                a, b = component(own), component(classes[j][1])
                root[max(a, b)] = min(a, b)
        here = inverted[side]
        for x in mine:
            here.setdefault(x, []).append(i)
    return links


def _blocks(classes: DataFrame) -> DataFrame:
    """(class, root, block) for (class, root, family): a large component has blocks of its own, small ones share.

    So two blocks of a large component hold one root and need not meet, and a small component is in one block.
    """
    of_root = classes.groupBy("family", "root").agg(F.count(F.lit(1)).alias("members"))
    small = of_root.filter(F.col("members") < BLOCK).groupBy("family").agg(F.sum("members").alias("small"))
    sizes = of_root.join(small, "family", "left").select(
        F.col("family").alias("_family"), F.col("root").alias("_root"), "members", "small"
    )
    met = classes.join(sizes, (F.col("family") == F.col("_family")) & (F.col("root") == F.col("_root")))
    own = F.xxhash64("family", "root", F.pmod(F.xxhash64("class"), F.ceil(F.col("members") / BLOCK)))
    shared = F.xxhash64("family", F.pmod(F.xxhash64("root"), F.ceil(F.col("small") / BLOCK)))
    return met.select("class", "root", F.when(F.col("members") < BLOCK, shared).otherwise(own).alias("block"))


def _pairs(held: DataFrame) -> DataFrame:
    """(one, two) of blocks that a list connects and that hold several roots in it, from (shingle, block, low, high).

    A self-join: one side of a list is dealt over salts by the number of its blocks, the other copied to each.
    """
    salts = held.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCKS).alias("salts"))
    met = held.join(salts, "shingle")
    one = met.select(
        "shingle", F.pmod(F.xxhash64("block"), "salts").alias("salt"), F.col("block").alias("one"),
        F.col("low").alias("low_one"), F.col("high").alias("high_one"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    two = met.select("shingle", every, F.col("block").alias("two"), F.col("low").alias("low_two"), F.col("high").alias("high_two"))
    several = (F.col("low_one") != F.col("low_two")) | (F.col("high_one") != F.col("high_two")) | (F.col("low_one") != F.col("high_one"))
    joined = one.join(two, ["shingle", "salt"]).filter((F.col("one") <= F.col("two")) & several)
    return joined.select("one", "two").distinct()


def _full_links(index: DataFrame, postings: DataFrame, roots: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links between components that share short lists."""
    told = postings.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
    told = told.select("shingle", "class", F.coalesce("root", "class").alias("root"))
    several = told.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("class").alias("first"))
    several = several.filter("low <> high").select("shingle", "first")
    open_lists = scratch.write(told.join(several, "shingle"), "open")
    families = components(open_lists.select(F.col("class").alias("a"), F.col("first").alias("b")), scratch)
    classes = open_lists.select("class", "root").distinct().join(families.withColumnRenamed("node", "class").withColumnRenamed("root", "family"), "class")
    blocks = scratch.write(_blocks(classes), "blocks")
    held = open_lists.select("shingle", "class").join(blocks, "class").groupBy("shingle", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    held = scratch.write(held, "held")
    scratch.release(open_lists)
    pairs = scratch.write(_pairs(held), "pairs")
    scratch.release(held)
    sides = pairs.select("one", "two", F.col("one").alias("block"), F.lit(0).alias("side")).union(
        pairs.filter("one <> two").select("one", "two", F.col("two").alias("block"), F.lit(1).alias("side"))
    )
    # a block may meet thousands of others: its classes are copied over salts
    often = sides.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / LIST_BLOCKS).alias("salts"))
    sides = sides.join(often, "block").withColumn("salt", F.pmod(F.xxhash64("one", "two"), "salts")).drop("salts")
    wanted = often.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    sets = index.select("class", "n", "by_value").join(blocks.join(wanted, "block"), "class")
    met = sides.join(sets, ["block", "salt"]).select("one", "two", "class", "root", "n", "by_value", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []

        def links() -> pa.RecordBatch:
            found = joins(held, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            for one, two, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if unit is not None and unit != (one, two):
                    yield links()
                    held = []
                unit = (one, two)
                held.append(tuple(row))
        if held:
            yield links()

    by_unit = met.repartition("one", "two").sortWithinPartitions("one", "two")
    return by_unit.mapInArrow(run, "a long, b long")


# --- the operator --------------------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (smallest id reachable by links).

    Documents link when 100 * shared >= ``percent`` * union of their sets of ``width``-word shingles.
    ``row_col`` names a column that tells rows apart (a long). It is then part of the result, with ``kept``: true
    for one row of each component, the first by id and number, and for rows without a shingle.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    parts = _parts_of(spark)
    with bounded_batches(spark):
        shared = scratch.write(_shared(_described(docs, id_col, text_col, width, parts, row_col), parts), "shared")
        documents = scratch.write(shared.filter("bucket IS NULL").select("doc_id", "class", "n", "row"), "documents")
        index = scratch.write(_index(shared.filter("bucket IS NOT NULL"), percent), "index")
        scratch.release(shared)
        postings = scratch.write(_postings(index), "postings")
        links = scratch.write(_first_links(index, postings, percent), "first")
        roots = components(links, scratch)
        more = scratch.write(_full_links(index, postings, roots, percent, scratch), "more")
        final = components(links.union(more), scratch)
    scratch.release(index, postings, links, more)
    return _named(documents, final, id_col, row_col)


def _named(documents: DataFrame, roots: DataFrame, id_col: str, row_col: str | None = None) -> DataFrame:
    """Every document with the smallest id of its component."""
    salt = F.pmod(F.xxhash64("doc_id", "row"), F.lit(SALTS)).cast("int")
    salted = documents.withColumn("salt", salt)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    some = salted.filter("class IS NOT NULL").groupBy("class", "salt").agg(F.min(rank).alias("low"))
    classes = some.groupBy("class").agg(F.min("low").alias("low"))
    rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "class"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("first"))
    named = rooted.join(lowest, "root").select("class", "first")
    told = some.join(named, "class").select("class", "salt", "first")
    joined = salted.join(told, ["class", "salt"], "left")
    kept = F.col("first").isNull() | (F.col("row") == F.col("first.row"))
    return joined.select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        *([F.col("row").alias(row_col), kept.alias("kept")] if row_col else []),
    )


#: The same rows in SQL.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, min(reach.b)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id, n.n
"""

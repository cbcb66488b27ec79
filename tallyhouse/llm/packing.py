"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the longest sequence is cut into pieces of that length and a rest; nothing is lost.
Pieces are dealt by hash into shards of similar size, and each shard is packed on its own, longest piece
first: a piece goes into the open bin it fills best, and if none has room, a bin is opened. The lengths
are optimised together: a shard is packed once for each way of opening bins (always one of the lengths, where
the piece fits, or the length with the least cost per word that the shard's remaining pieces can fill), every
bin is then downsized to the shortest permitted length that holds its contents, and the cheapest packing is kept. A
sequence costs its length and a fixed overhead.

A shard's pieces are three numbers each, so a task holds a bounded table whatever the corpus; more documents
make more shards. Best fit over tens of thousands of pieces wastes next to nothing compared with packing
everything at once.

Defined results: a document without words, null or empty, takes no place in any bin and has no row. Rows that
repeat an id are packed each for itself. An empty table gives an empty result. Columns other than id and text
are not read. Reruns agree: a shard is ordered by length, then hash and id.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, whole_text, word_count

#: Permitted sequence lengths in words.
LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a sequence besides its length, in words.
OVERHEAD = 32
SHARD_PIECES = 20_000
_BIN_BITS = 32


def _cheapest_opening(size: int, left: int, lengths: tuple[int, ...], overhead: int) -> int:
    """The length with the least cost per word, if the remaining ``left`` words fill it as far as they go."""
    fitting = [x for x in lengths if x >= size]
    return min(fitting, key=lambda x: ((x + overhead) / min(x, max(left, size)), x))


def best_fit(sizes: list[int], lengths: tuple[int, ...], opening: int | None, overhead: int) -> tuple[list[int], list[int]]:
    """Bin of each piece and content of each bin; ``sizes`` falls, ``opening`` is the length of new bins
    where it fits, or None for the cheapest."""
    room: list[int] = []  # distinct free spaces of open bins, rising
    bins_of: dict[int, list[int]] = {}
    chosen, content = [], []
    left = sum(sizes)
    for size in sizes:
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            same = bins_of[free]
            number = same.pop()
            if not same:
                del bins_of[free], room[at]
        else:
            if opening is None:
                free = _cheapest_opening(size, left, lengths, overhead)
            else:
                free = next(x for x in lengths if x >= max(size, opening))
            number = len(content)
            content.append(0)
        content[number] += size
        chosen.append(number)
        left -= size
        free -= size
        if free:
            if free not in bins_of:
                insort(room, free)
                bins_of[free] = []
            bins_of[free].append(number)
    return chosen, content


def pack_shard(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """Bin of each piece and final length of each bin, of the cheapest packing."""
    best = None
    for opening in (None, *reversed(lengths)):
        chosen, content = best_fit(sizes, lengths, opening, overhead)
        final = [lengths[bisect_left(lengths, x)] for x in content]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = cost, chosen, final
    return best[1], best[2]


PACKED = "doc_id long, piece int, start long, size int, bin_id long, bin_length int, place int"


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS,
    overhead: int = OVERHEAD, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: id, number and first word of the piece, its size, bin, the bin's length, and the
    piece's place in it."""
    lengths = tuple(sorted(set(lengths)))
    longest = lengths[-1]
    scratch = Scratch(docs.sparkSession, "pack")
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), word_count(text_col).alias("words"), F.xxhash64(whole_text(text_col)).alias("digest"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1, F.lit(longest).cast("long")))
    pieces = counted.filter("words > 0").select("doc_id", "words", "digest", starts.alias("start")).select(
        "doc_id", F.floor(F.col("start") / longest).cast("int").alias("piece"), "start",
        F.least(F.col("words") - F.col("start"), F.lit(longest)).cast("int").alias("size"),
        F.xxhash64("doc_id", F.floor(F.col("start") / longest), "digest").alias("hash"),  # ids may be missing or repeat
    )
    pieces = scratch.write(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def packed() -> Iterator[pa.RecordBatch]:
            sizes = [x[3] for x in held]
            chosen, final = pack_shard(sizes, lengths, overhead)
            used = [0] * len(final)
            rows = []
            for (name, piece, start, size), number in zip(held, chosen, strict=True):
                rows.append((name, piece, start, size, (shard << _BIN_BITS) + number, final[number], used[number]))
                used[number] += size
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            names = [x.split()[0] for x in PACKED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for of, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard is not None and of != shard:
                    yield from packed()
                    held = []
                shard = of
                held.append(row)
        if held:
            yield from packed()

    in_order = dealt.repartition("shard").sortWithinPartitions("shard", F.desc("size"), "hash", "doc_id", "piece")
    return in_order.select("shard", "doc_id", "piece", "start", "size").mapInArrow(run, PACKED)

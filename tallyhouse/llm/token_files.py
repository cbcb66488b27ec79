"""Token ids in byte-aligned variable-length coding.

Ids are replaced by their rank in order of frequency, so that common ids are small numbers, and written
in one to four bytes. Lengths stand apart from the data: control bytes hold two bits per id. A decoder
therefore works without branches: a table with a row per control byte gives the lengths of its four ids,
their running sum gives the places, and numpy gathers the bytes.

The file format is a Parquet table with one row per block of documents in ascending order of ids:
``part`` and ``first`` (ids before it in its part), ``doc_ids``, ``lengths`` (ids per document),
``control``, ``data``. Beside it lie the table of ranks, one row per id of the vocabulary, and the table
of parts with the ids before each. Parquet lets any reader take the blocks it needs, and tasks commit
whole files, so that a lost executor leaves no half block.

Texts are encoded once. Words repeat, so those of a batch are told apart first, and each worker keeps the
ids of words it has met; the cache is bounded and only saves time. What goes to the driver is one count per id of the vocabulary, whose size is fixed.

Defined results: a null text counts as empty and gives just the end id. Rows that repeat a doc_id are
documents of their own, next to each other; a null doc_id comes first. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from tokenizers import Tokenizer

from tallyhouse.llm.common import Scratch, whole_text
from tallyhouse.session import scratch_path

#: Words of a worker's cache, of which there are a present and a former one.
CACHE_WORDS = 500_000
#: Documents encoded together.
STEP_DOCUMENTS = 1000
BLOCK_IDS = 1 << 20


def _kind(vocabulary_size: int) -> str:
    """Number type of ids between the tasks."""
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


class _ByteLetters(dict):
    """Letters as the tokenizer's byte-level step spells them, asked for once."""

    def __init__(self, spell) -> None:
        self._spell = spell

    def __missing__(self, code: int) -> str:
        self[code] = "".join(part for part, _ in self._spell(chr(code)))
        return self[code]


class WordEncoder:
    """Texts to packed ids, equal to encoding each text whole.

    The tokenizer drops white space and lower-cases, so words can be encoded one by one, and each distinct word
    of a batch once. Words of plain letters are one piece for the tokenizer's model, which is asked directly; other
    words pass the whole tokenizer. A comma or full stop after letters is a token of its own. A text that may
    spell a special token is left to the tokenizer as it is.
    """

    def __init__(self, path: str, end_id: int | None = None, most_words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = _ByteLetters(self._tokenizer.pre_tokenizer.pre_tokenize_str)
        self._most_words = most_words
        self._kind = np.dtype(_kind(self._tokenizer.get_vocab_size()))
        self._end = b"" if end_id is None else np.array([end_id], self._kind).tobytes()
        self._known: dict[str, bytes] = {}
        self._former: dict[str, bytes] = {}
        self._marks = dict(zip(",.", self._each([",", "."]), strict=True))

    def _each(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self._kind).tobytes() for x in found]

    def _learn(self, words: list[str]) -> None:
        known, tokenize = self._known, self._model.tokenize
        code = "H" if self._kind.itemsize == 2 else "I"
        marked, other = [], []
        plain = dict.fromkeys(words)
        for word in words:
            if word[-1:] in self._marks and word[:-1].isalpha():
                marked.append(word)
                del plain[word]
                if word[:-1] not in known:
                    plain[word[:-1]] = None
        for word in plain:
            if word.isalpha() and (word.isascii() or max(word) <= "ÿ"):
                spelt = word if word.isascii() else word.lower().translate(self._letters)
                known[word] = array(code, [t.id for t in tokenize(spelt)]).tobytes()
            else:
                other.append(word)
        known.update(zip(other, self._each(other), strict=True))
        known.update((w, known[w[:-1]] + self._marks[w[-1]]) for w in marked)

    def _ids_of(self, words: list[str]) -> list[bytes]:
        found = list(map(self._known.get, words))
        if None in found:
            missing = [w for w, ids in zip(words, found, strict=True) if ids is None]
            if self._known and len(self._known) + len(missing) > self._most_words:
                self._former, self._known, missing = self._known, {}, words
            former = self._former
            self._known.update((w, former[w]) for w in missing if w in former)
            self._learn([w for w in missing if w not in self._known])
            found = list(map(self._known.get, words))
        return found

    def __call__(self, texts: pa.Array) -> pa.Array:
        """The packed ids of each text, with the end id, as binary."""
        texts = texts.cast(pa.string())
        special = pc.match_substring(texts, "<|")
        whole = {}
        if pc.any(special).as_py():
            at = np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist()
            whole = dict(zip(at, self._each([texts[i].as_py() for i in at]), strict=True))
            texts = pc.if_else(special, "", texts)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        ids = pa.array([*self._ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), self._end], pa.large_binary())
        # the end id is one more word of each text
        ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)) + np.arange(len(texts))
        met = np.empty(len(words) + len(texts), np.int32)
        is_word = np.ones(len(met), bool)
        is_word[ends] = False
        met[ends] = len(ids) - 1
        met[is_word] = words.indices.to_numpy(zero_copy_only=False)
        packed = ids.take(pa.array(met))
        _, places, data = packed.buffers()
        offsets = np.concatenate([[0], np.frombuffer(places, np.int64)[1:][ends]])
        if offsets[-1] < 1 << 31 and not whole:
            return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), data])
        raw = memoryview(data)
        rows = [bytes(raw[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
        for i, ids_of_text in whole.items():
            rows[i] = ids_of_text + self._end
        return pa.array(rows, pa.binary())


@cache
def _encoder(path: str, end_id: int) -> WordEncoder:
    """One per worker, which serves many tasks."""
    return WordEncoder(path, end_id)


def encoded(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, packed ids with the end id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary, end_id)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_DOCUMENTS):
                part = batch.slice(at, STEP_DOCUMENTS)
                yield pa.RecordBatch.from_arrays([part.column(0), encode(part.column(1))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary")


def id_counts(ids: DataFrame, size: int) -> DataFrame:
    """(id, n) over all documents; each task sends one row per id it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind = np.zeros(size, np.int64), _kind(size)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                row = b"".join(batch.column(0).slice(at, 500).to_pylist())
                counts += np.bincount(np.frombuffer(row, kind), minlength=size)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits per value: bytes less one) and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4", copy=False)
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4)[None, :] <= extra[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


#: Bytes of each of the four values that a control byte describes.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values of ``pack``."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    starts = ends - lengths
    result = raw[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(lengths > byte)
        result[longer] |= raw[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return result


BLOCKS = "part int, first long, doc_ids array<long>, lengths array<long>, control binary, data binary"


def _blocks(ids: DataFrame, ranks: np.ndarray, block_ids: int) -> DataFrame:
    """Packs sorted documents; a block closes once it holds ``block_ids`` ids."""
    shared = ids.sparkSession.sparkContext.broadcast(ranks)  # one number per id of the vocabulary
    kind = np.dtype(_kind(len(ranks)))
    schema = pa.schema(
        [("part", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, size = TaskContext.get().partitionId(), 0, 0
        names: list[int] = []
        held: list[bytes] = []

        def block() -> pa.RecordBatch:
            control, data = pack(shared.value[np.frombuffer(b"".join(held), kind)])
            row = [part, first, names, [len(x) // kind.itemsize for x in held], control, data]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema=schema)

        for batch in batches:
            for name, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names.append(name)
                held.append(row)
                size += len(row) // kind.itemsize
                if size >= block_ids:
                    yield block()
                    first, size = first + size, 0
                    names, held = [], []
        if names:
            yield block()

    return ids.mapInArrow(run, BLOCKS)


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, vocabulary_size: int, end_id: int,
    id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS,
) -> None:
    """Encode all documents and write ``path``/ranks, ``path``/blocks and ``path``/parts."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    ids = scratch.write(encoded(docs, vocabulary, end_id, id_col, text_col), "ids")
    counts = id_counts(ids, vocabulary_size).toPandas()  # at most a row per id of the vocabulary
    frequency = np.zeros(vocabulary_size, np.int64)
    frequency[counts["id"].to_numpy()] = counts["n"].to_numpy()
    by_rank = np.lexsort((np.arange(vocabulary_size), -frequency))
    ranks = np.empty(vocabulary_size, "<u4")
    ranks[by_rank] = np.arange(vocabulary_size, dtype="<u4")
    listed = [(r, int(i), int(frequency[i])) for r, i in enumerate(by_rank)]
    spark.createDataFrame(listed, "rank int, id int, n long").coalesce(1).write.parquet(f"{path}/ranks")

    # ids of documents may repeat: a digest of the tokens goes along in the order, so that reruns agree
    order = ["doc_id", F.xxhash64("ids")]
    in_order = ids.repartitionByRange(*order).sortWithinPartitions(*order)
    _blocks(in_order, ranks, block_ids).write.parquet(f"{path}/blocks")
    scratch.release(ids)
    in_block = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
    parts = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum(in_block).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts.write.parquet(f"{path}/parts")


def read_token_files(
    spark: SparkSession, path: str, each: Callable[[np.ndarray], tuple], schema: str
) -> DataFrame:
    """Decode the blocks; ``each`` turns the ids of one document into the further columns of ``schema``.

    The result starts with doc_id, start and n_tokens. ``ids_of`` and ``ids_crc32`` are ready uses.
    """
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toPandas()
    shared = spark.sparkContext.broadcast(table["id"].to_numpy().astype("<u4"))
    parts = spark.read.schema("part int, start long").parquet(f"{path}/parts")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").join(F.broadcast(parts), "part")
    further = _parse_datatype_string(schema)
    whole = _parse_datatype_string("doc_id long, start long, n_tokens long")
    for field in further.fields:
        whole = whole.add(field)
    target = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = shared.value[unpack(row["control"], row["data"], sum(row["lengths"]))]
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                more = zip(*[each(ids[a:b]) for a, b in zip(starts, ends, strict=True)], strict=True)
                columns = [row["doc_ids"], starts + row["start"] + row["first"], row["lengths"], *map(list, more)]
                yield pa.RecordBatch.from_pydict(dict(zip(target.names, columns, strict=True)), schema=target)

    return blocks.mapInArrow(run, whole)


def ids_of(ids: np.ndarray) -> tuple:
    """For ``array<int>``: the ids themselves."""
    return (ids.tolist(),)


def ids_crc32(ids: np.ndarray) -> tuple:
    """For ``long``: unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def token_digests(docs: DataFrame, vocabulary: str, vocabulary_size: int, end_id: int) -> DataFrame:
    """Write the files to the shared folder and return each document's digest, read back from them."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, vocabulary, vocabulary_size, end_id)
    return read_token_files(docs.sparkSession, path, ids_crc32, "ids_crc32 long")

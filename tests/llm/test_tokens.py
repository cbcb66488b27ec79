"""Token files: round trip, equality with the tokenizer, positions."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from texts import documents  # noqa: F401

from tallyhouse.llm import token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300) | st.integers(0, 70_000), max_size=200))
def test_pack_round_trip(values):
    given_values = np.array(values, np.uint32)
    control, data = token_files.pack(given_values)
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


TEXTS = [
    "The Cat, sat. It's the cat's mat; don't!", "a\x0bb\x1cc d e", "", None, "<|endoftext|> x <|STARTOFTEXT|>", "foo., bar,\nbaz.\tqux",
    "é Å İstanbul ΣΑΣ. ſ", "12,5 a1. x,y z..", "word " * 3000, "naïve, Straße. 你好。", "한국 한", "क़ ख़,",
    "a,. b., c.", "x" * 2000,
]


def whole(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("most_words", [3, 1_000_000])
def test_words_encode_as_whole_texts(most_words):
    encoder = token_files.WordEncoder(VOCABULARY, most_words=most_words)
    given_texts = [t or "" for t in TEXTS]
    without = [t for t in given_texts if "<|" not in t]
    for texts in (given_texts, given_texts[::-1], given_texts[:3], without, []):
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder(pa.array(texts, pa.string())).to_pylist()]
        assert got == whole(texts)


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    encoder = token_files._encoder(VOCABULARY, 1)
    got = encoder(pa.array([text, "é", text])).to_pylist()
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [[*x, 1] for x in whole([text, "é", text])]


def test_files(documents, spark, tmp_path):
    rows = list(zip([7, 3, 9, 1, 100, 12, 5, 6, 8, 2, 4, 11, 10, 3], TEXTS))
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(*rows), path, VOCABULARY, 49_408, 1, block_ids=50)
    ids = {}
    for (name, _), found in zip(rows, whole(TEXTS)):
        ids.setdefault(name, []).append([*found, 1])
    got = token_files.read_token_files(spark, path, token_files.ids_of, "ids array<int>").orderBy("start").collect()
    start = 0
    assert [r["doc_id"] for r in got] == sorted(i for i, _ in rows)
    for r in got:
        assert r["ids"] in ids[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(r["ids"])
        start += r["n_tokens"]
    sums = token_files.read_token_files(spark, path, token_files.ids_crc32, "crc long").orderBy("start").collect()
    assert [r["crc"] for r in sums] == [zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got]
    first = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("n").limit(50).collect()
    assert [r["n"] for r in first] == sorted((r["n"] for r in first), reverse=True)


def test_empty_table(documents):
    none = documents((1, "a")).filter("doc_id > 5")
    assert token_files.token_digests(none, VOCABULARY, 49_408, 1).collect() == []

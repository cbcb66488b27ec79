"""Language identification: held-out documents, mixed texts, and the best path against all paths."""

from __future__ import annotations

import random
import zlib
from itertools import product

import numpy as np
import pytest
from texts import DOCUMENTS

from tallyhouse.llm import language

SYLLABLES = {
    "aa": ["tion", "the", "ing", "er", "sh", "ou", "wh"],
    "bb": ["sch", "ung", "ein", "für", "ö", "keit", "ach"],
    "cc": ["ción", "que", "ñ", "ado", "los", "ez", "mi"],
    "ru": ["ого", "пр", "ени", "ст", "ать", "во", "щи"],
}


def prose(lang, n, seed):
    draw = random.Random(f"{lang}{seed}")
    words = ["".join(draw.choice(SYLLABLES[lang]) for _ in range(draw.randrange(1, 4))) for _ in range(n)]
    return " ".join(w + draw.choice(["", "", ",", ".", " 12"]) for w in words)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCUMENTS).selectExpr("*", "'x' AS score", "'x' AS spans", "'x' AS id", "1 AS n").repartition(3)


@pytest.fixture(scope="module")
def corpus():
    langs = ["aa", "bb", "cc", "ru"]
    return [(i, prose(langs[i % 4], 60 + i % 50, i), langs[i % 4]) for i in range(160)]


@pytest.fixture(scope="module")
def model(spark, corpus):
    return language.learn(table(spark, corpus))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_held_out_documents(spark, corpus, model):
    got = by_id(language.identify(table(spark, corpus), model))
    assert len(got) == len(corpus)
    for i, text, lang in corpus:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["lang_pred"] == lang and 0.99 < got[i]["score"] <= 1
        assert [tuple(s) for s in got[i]["spans"]] == [(0, len(text), lang)]


def test_held_out_rows_teach_nothing(spark, corpus, model):
    other = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in corpus]
    again = language.learn(table(spark, other))
    assert again.languages == model.languages and (again.scores == model.scores).all()


def test_spans_of_mixed_text(spark, model):
    parts = [prose("aa", 80, 1), prose("bb", 40, 2), prose("aa", 30, 3), "и " + prose("ru", 20, 4)]
    text = "\n".join(parts)
    row = language.identify(table(spark, [(1, text, None)]), model).collect()[0]
    assert row["lang_pred"] == "aa" and 0 < row["score"] < 1
    assert [s["lang"] for s in row["spans"]] == ["aa", "bb", "aa", "ru"]
    assert row["spans"][0]["start"] == 0 and row["spans"][-1]["end"] == len(text)
    at = 0
    for part, span in zip(parts, row["spans"], strict=True):
        assert abs(span["start"] - at) < 25
        at += len(part) + 1


def test_script_narrows_candidates(model):
    scores, letters = model.words([language.bare(w) for w in ["«привет»", "tion", "12", "γλώσσα"]])
    assert (scores[0][:3] == language.OUTSIDE).all() and scores[0][3] > language.OUTSIDE
    assert scores[1][3] == language.OUTSIDE and not scores[2].any() and letters.tolist() == [6, 4, 0, 6]
    assert (scores[3] > language.OUTSIDE).all()  # a script nobody uses leaves all
    assert language.tokens("abc漢字かな def") == ["abc", "漢字", "かな", "def"]


def test_best_path_is_the_best_of_all():
    draw = np.random.default_rng(1)
    docs = [draw.normal(size=(n, 3)) * 2 for n in (1, 2, 5, 6, 6, 3)]
    for scores, path in zip(docs, language.best_paths(docs, 1.5), strict=True):
        def value(p):
            return sum(scores[i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(path) == pytest.approx(max(map(value, product(range(3), repeat=len(scores)))))


def test_single_language_only_where_the_path_agrees():
    draw = np.random.default_rng(2)
    sure = 0
    for _ in range(300):
        scores = draw.normal(size=(draw.integers(1, 30), 3)) + [0.8, 0, 0]
        alone = language.single_language(scores, 4.0)
        if alone is not None:
            sure += 1
            path = language.best_paths([scores], 4.0)[0]
            changes = np.count_nonzero(np.diff(path))
            assert scores[np.arange(len(path)), path].sum() - 4.0 * changes == pytest.approx(scores[:, alone].sum())
    assert sure > 100


def test_small_caches_and_steps_change_nothing(corpus, model, monkeypatch):
    texts = [t for _, t, _ in corpus] + [prose("aa", 50, 7) + " " + prose("cc", 50, 8), None, ""]
    wanted = language.Labeller(model).rows(texts)
    monkeypatch.setattr(language, "STEP_WORDS", 100)
    monkeypatch.setattr(language, "STEP_DOCUMENTS", 3)
    assert language.Labeller(model, most_words=50).rows(texts) == wanted


def test_defined_results(spark, model):
    long_text = prose("cc", 30_000, 9)
    rows = [(1, None, "aa"), (2, "", None), (3, "123 ... %", None), (4, long_text, None), (4, long_text, None), (None, prose("bb", 20, 1), None), (5, "x" * 200_000, None), (6, "一丁丂 😀", None)]
    got = language.identify(table(spark, rows), model).collect()
    assert len(got) == 8
    for r in got:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, None)
        elif r["doc_id"] == 4:
            assert r["lang_pred"] == "cc"
        else:
            assert r["lang_pred"] in model.languages and 0 <= r["score"] <= 1
    assert [r["lang_pred"] for r in got if r["doc_id"] is None] == ["bb"]
    assert language.identify(table(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    rows = [(2, "text", None), (3, None, "aa")]
    assert language.learn(table(spark, rows)) is None and language.learn(table(spark, [])) is None
    got = language.identify(table(spark, rows), None)
    assert [(r["lang_pred"], r["score"]) for r in got.collect()] == [("und", 0.0)] * 2
    one = language.learn(table(spark, [(1, "text", "aa"), (7, None, "bb"), (8, "...", "aa")]))
    assert one.languages == ("aa",)
    assert language.identify(table(spark, rows), one).filter("doc_id = 2").collect()[0]["lang_pred"] == "aa"

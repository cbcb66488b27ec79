"""The trained operators on invented texts with a known rule, held out."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import documents, words  # noqa: F401

from tallyhouse.llm import quality, toxicity, training

BAD = ["nasty", "vile", "rotten"]


def corpus(n=900):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(words(i * 50 + j, 8)) for j in range(draw.randrange(1, 12))]
        toxic = i % 3 == 0
        if toxic:
            at = draw.randrange(len(sentences))
            sentences[at] += " " + draw.choice(BAD) + draw.choice(["", "!!", "##"])
        text = ". ".join(sentences) + "."
        poor = i % 4 == 1
        if poor:
            text = " | ".join(text.upper().split())
        rows.append((i, text))
        labels.append((i, 0 if poor else 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(*x, "z") for x in corpus()[1]], "doc_id long, quality int, toxic int, text string")


def test_toxicity(documents, labels):
    rows, known = corpus()
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "fine words " * 5000), (5004, "fine words " * 5000 + "you vile thing"), (5005, "Nasty"), (5005, "Nasty")]
    got = {r["doc_id"]: r for r in toxicity.toxicity(documents(*rows), labels).collect()}
    for i in (5000, 5001, 5002):
        assert got[i]["score"] == 0 and got[i]["worst_start"] is None
    assert got[5003]["predicted"] == 0 and got[5004]["predicted"] == 1
    right = []
    for i, _, toxic in known:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"]:
            right.append(r["predicted"] == toxic)
        if toxic and r["predicted"]:
            sentence = rows[i][1][r["worst_start"] : r["worst_end"]].lower()
            assert any(b in sentence for b in BAD)
    assert np.mean(right) > 0.97


def test_toxicity_filter_and_no_labels(documents, labels):
    docs = documents((1, "vile"), (2, "fine words"), (3, None))
    model = toxicity.train(documents(*corpus()[0]), labels)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    none = toxicity.toxicity(docs, labels.filter("doc_id < 0")).collect()
    assert {r["score"] for r in none} == {0.0}
    assert toxicity.toxicity(docs.filter("doc_id > 5"), labels).collect() == []


def test_long_sentences_are_cut():
    text = "a b c " * 100
    found = list(toxicity.sentences(text))
    assert len(found) == 8 and text[found[0][0] : found[0][1]].split() == text.split()[:40]
    assert list(toxicity.sentences("")) == [] and list(toxicity.sentences("...")) == []


def test_quality(documents, labels):
    rows, known = corpus()
    rows += [(5000, None), (5001, " "), (5003, "fine words. " * 5000)]
    got = {r["doc_id"]: r for r in quality.quality(documents(*rows), labels).collect()}
    assert not got[5000]["kept"] and got[5001]["expected_grade"] == 0
    held = [(got[i], q, t) for i, q, t in known if got[i]["held_out"]]
    assert np.mean([r["kept"] == (q == 1) for r, q, _ in held]) > 0.97
    mean = [np.mean([r["expected_grade"] for r, q, t in held if (0 if not q else 1 if t else 2) == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert all(0 <= r["expected_grade"] <= 2 and 0 <= r["tail"] <= 1 for r in got.values())
    assert quality.quality(documents(*rows).filter("doc_id < 0"), labels).collect() == []


def plain_features(text):
    """The features counted one by one, as text."""
    found = Counter()
    words = text.split()
    kinds = [quality.shape(w) for w in words]
    for word, kind in zip(words, kinds):
        found["s" + kind] += 1
        found[f"n{min(len(word), 20)}"] += 1
        letters = "".join(c for c in word.lower() if c.isalpha())
        if letters:
            found["w" + letters] += 1
    for i in range(1, len(words)):
        found[f"p{kinds[i - 1]} {kinds[i]}"] += 1
    if words:
        found["repeats"] += sum(a == b for a, b in zip(words, words[1:]))
        found["distinct"] += len(set(words))
    total = Counter()
    for name, n in found.items():
        total[training.place(name)] += n
    return {at: (n / len(words)) ** 0.5 for at, n in total.items()}


@pytest.mark.parametrize("most", [3, 300_000])
def test_features_are_those_counted_one_by_one(monkeypatch, most):
    monkeypatch.setattr(quality, "CACHE_WORDS", most)
    known = quality.Words()
    for text in ["", " ", "one", "a a a b, a", "Ärger über 12,5 % -- x_y ÉCOLE ß ǅ", "中文 中文 abc ABC aBc 3rd", *(t for _, t in corpus(30)[0])]:
        places, shares = quality.features(text, known)
        wanted = plain_features(text)
        assert len(set(places.tolist())) == len(places) and set(places.tolist()) == set(wanted)
        assert np.allclose(shares, [wanted[p] for p in places.tolist()], rtol=1e-6)


def test_quality_fits_and_scores_as_a_plain_loop(documents, labels):
    """Training on every feature of the sample, by the driver alone, gives the same model; so do plain sums the same scores."""
    rows, known = corpus()
    learned = [(i, g) for i, q, t in known for g in [0 if not q else 1 if t else 2] if zlib.crc32(str(i).encode()) % 5]
    words = quality.Words()
    # a repeated id counts once, by the text of smallest digest
    other = "another text of the same id"
    texts = {i: t for i, t in rows} | {learned[0][0]: min(rows[learned[0][0]][1], other, key=lambda t: hashlib.sha256(t.encode()).hexdigest())}
    plain = quality.fit([quality.features(texts[i], words) for i, _ in learned], np.array([g for _, g in learned]), 3)
    docs = documents(*rows, *[(learned[0][0], t) for t in (other, other)])
    model = quality.train(docs, quality.given_grades(labels), 3)
    assert set(np.flatnonzero(plain.weights)) == set(np.flatnonzero(model.weights))
    assert np.allclose(plain.weights, model.weights, atol=1e-4) and np.allclose(plain.thresholds, model.thresholds, atol=1e-4)
    got = {r["doc_id"]: r for r in quality.score(documents(*rows), model).collect()}
    for i, text in rows[::7]:
        x = sum(model.weights[at] * share for at, share in plain_features(text).items())
        above = [1 / (1 + np.exp(cut - x)) for cut in model.thresholds]
        assert np.isclose(got[i]["expected_grade"], sum(above), atol=1e-5) and np.isclose(got[i]["tail"], above[0], atol=1e-5)


def test_one_grade_only_and_long_texts_of_new_words(documents, labels):
    docs = documents((1, "x y z"), (2, None), (3, " ".join(f"w{i}" for i in range(30_000))))
    good = labels.withColumn("quality", labels["quality"] * 0 + 1).withColumn("toxic", labels["toxic"] * 0)
    got = sorted(tuple(r) for r in quality.quality(docs, good).select("doc_id", "expected_grade", "kept").collect())
    assert [g[:2] for g in got] == [(1, 0.0), (2, 0.0), (3, 0.0)]


def test_thresholds_are_ordered():
    draw = np.random.default_rng(0)
    grades = draw.integers(0, 4, 400)
    rows = [(np.array([g, 10]), np.array([1.0, draw.random()])) for g in grades]
    model = quality.fit(rows, grades, 4)
    assert (np.diff(model.thresholds) > 0).all()


def test_sample_is_bounded_and_leaves_out_the_held(documents, labels):
    sample = training.labelled_sample(documents(*corpus()[0]), labels.selectExpr("doc_id", "toxic AS grade"), 2, most_per_class=40).collect()
    assert sorted({r["grade"] for r in sample}) == [0, 1] and len(sample) == 80
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in sample)

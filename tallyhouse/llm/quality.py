"""Quality by ordinal regression.

Ratings are grades 0 to K - 1. One weight vector over hashed features of the text gives a position on a
scale, and K - 1 ordered thresholds cut the scale: P(grade > k) = sigmoid(w x - t_k). The thresholds are
a first value and positive steps, so they stay ordered while all are learned together. Each document gets its
expected grade, the sum of these probabilities, and the probability of reaching the grade asked
for, on which it is kept or not.

Features are shares of a text's words: the word, its shape (letters, capitals, digits, other marks), pairs
of shapes, whether it repeats the word before, and how long it is. A word's features are cached, so a
text takes one look-up per word.

The model is fitted by the driver on a bounded sample of rated documents (``MOST_PER_CLASS`` per grade,
never a held-out one), whose features tasks extract and choose; every whole text is scored by tasks.

Defined results: null, empty and blank texts have no features; their expected grade is 0 and they are not
kept. Rows that repeat a doc_id are scored each for itself. Without two grades in the sample every document
is kept with grade 0. An empty table gives an empty result. Ratings, language, source and id are no inputs of a
score; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, whole_text
from tallyhouse.llm.training import (
    BUCKETS, LEAST_DOCUMENTS, LEAST_Z, MOST_PER_CLASS, Adam, associated, held_out, labelled_sample, place, sigmoid,
)

CACHE_WORDS = 300_000
_SHAPES = [(re.compile(r"[^\W\d_A-ZÀ-Þ]+"), "a"), (re.compile(r"[A-ZÀ-Þ]+"), "A"), (re.compile(r"\d+"), "0")]


def shape(word: str) -> str:
    """Runs of small letters, capitals and digits as one sign each, other marks as they are (8 at most)."""
    for pattern, sign in _SHAPES:
        word = pattern.sub(sign, word)
    return word[:8]


def _of_word(word: str) -> tuple[str, tuple[int, ...]]:
    if word.isascii() and word.isalpha() and word.islower():
        kind, letters = "a", word  # the common case; the general one gives the same
    else:
        kind, letters = shape(word), "".join(filter(str.isalpha, word.lower()))
    found = [_named("s" + kind), _named(f"n{min(len(word), 20)}")]
    if letters:
        found.append(place("w" + letters))
    return kind, tuple(found)


_named = lru_cache(10_000)(place)


class Words(dict):
    """Numbers of the words met and, by number, their shapes and places; starts anew when it is full."""

    def __init__(self) -> None:
        super().__init__()
        self._start()

    def _start(self) -> None:
        self.clear()
        self._shapes: dict[str, int] = {}
        self._kind = np.zeros(1024, np.int64)
        self._places = np.full((1024, 3), BUCKETS, np.int32)
        self._pairs: dict[int, int] = {}

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self._kind):
            self._kind = np.concatenate([self._kind, np.zeros_like(self._kind)])
            self._places = np.concatenate([self._places, np.full_like(self._places, BUCKETS)])
        kind, found = _of_word(word)
        self._kind[number] = self._shapes.setdefault(kind, len(self._shapes))
        self._places[number, : len(found)] = found
        self[word] = number
        return number

    def counted(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text's features and how often; a place may stand there several times.

        Place ``BUCKETS`` is that of no feature.
        """
        if len(self) > CACHE_WORDS:
            self._start()
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        kinds = self._kind[numbers]
        codes, times = np.unique((kinds[:-1] << 32) | kinds[1:], return_counts=True)
        codes = codes.tolist()
        missing = [c for c in codes if c not in self._pairs]
        if missing:
            names = list(self._shapes)
            for c in missing:
                self._pairs[c] = place(f"p{names[c >> 32]} {names[c & 0xFFFFFFFF]}")
        pairs = np.fromiter(map(self._pairs.__getitem__, codes), np.int32, len(codes))
        own = self._places[numbers].ravel()
        repeats, distinct = np.count_nonzero(numbers[1:] == numbers[:-1]), len(set(words))
        places = np.concatenate([own, pairs, np.array([REPEATS, DISTINCT], np.int32)])
        counts = np.concatenate([np.ones(len(own), np.int64), times, [repeats, distinct]])
        return places, counts


REPEATS, DISTINCT = place("repeats"), place("distinct")


def features(text: str, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights; the square root of a share lets a few words count."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    places, counts = known.counted(words)
    places, at = np.unique(places, return_inverse=True)
    total = np.bincount(at, counts)
    if places[-1] == BUCKETS:
        places, total = places[:-1], total[:-1]
    return places, np.sqrt(total.astype(np.float32) / len(words))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, classes: int, rounds: int = 200, decay: float = 1e-5) -> Model:
    """Cumulative-link model; grades weigh alike, however many documents have them."""
    some = [i for i, r in enumerate(rows) if len(r[0])]
    rows, grades = [rows[i] for i in some], grades[some]
    if len(set(grades.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), np.full(classes - 1, -np.inf))
    flat = np.concatenate([r[0] for r in rows])
    shares = np.concatenate([r[1] for r in rows]).astype(np.float64)
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    chosen = np.zeros(BUCKETS, bool)
    for k in range(classes - 1):
        if 0 < (grades > k).sum() < len(grades):
            chosen |= associated(owner, flat, shares, (grades > k).astype(float), BUCKETS)
    keep = chosen[flat]
    used, flat = np.unique(flat[keep], return_inverse=True)
    shares, owner = shares[keep], owner[keep]
    above = (grades[:, None] > np.arange(classes - 1)).astype(float)
    weight = 1.0 / np.bincount(grades, minlength=classes)[grades] / len(set(grades.tolist()))
    values = {"w": np.zeros(len(used)), "first": np.array([0.0]), "steps": np.zeros(classes - 2)}
    adam = Adam()
    for _ in range(rounds):
        steps = np.exp(values["steps"])
        cuts = values["first"] + np.concatenate([[0.0], np.cumsum(steps)])
        x = np.bincount(owner, values["w"][flat] * shares, len(rows))
        gap = (sigmoid(x[:, None] - cuts) - above) * weight[:, None]  # slope of the loss in w x - t_k
        of_cut = -gap.sum(0)
        later = np.cumsum(of_cut[::-1])[::-1]
        adam.update(
            values,
            {
                "w": np.bincount(flat, gap.sum(1)[owner] * shares, len(used)) + decay * values["w"],
                "first": later[:1],
                "steps": later[1:] * steps,
            },
        )
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = values["w"]
    cuts = values["first"] + np.concatenate([[0.0], np.cumsum(np.exp(values["steps"]))])
    return Model(weights, cuts)


def _chosen(table: DataFrame, classes: int) -> np.ndarray:
    """Which features :func:`fit` would use; tasks add up, and what may count comes back, ``BUCKETS`` rows at most.

    Places of the features that every text has are chosen too, so that no document of the sample is without any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per feature its documents, weights, squares, and weights of the documents above each threshold
        sums = np.zeros((classes + 2, BUCKETS))
        for batch in batches:
            for grade, places, shares in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, w = np.frombuffer(places, np.int32), np.frombuffer(shares, np.float32).astype(np.float64)
                sums[0, at] += 1
                sums[1, at] += w
                sums[2, at] += w * w
                for k in range(min(grade, classes - 1)):
                    sums[3 + k, at] += w
        met = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *(pa.array(x[met]) for x in sums)], ["place", *names])

    names = [f"s{i}" for i in range(classes + 2)]
    partial = table.select("grade", "places", "shares").mapInArrow(run, ", ".join(["place int", *(f"{x} double" for x in names)]))
    added = partial.groupBy("place").agg(*(F.sum(x).alias(x) for x in names))
    rows = added.filter(F.col("s0") >= LEAST_DOCUMENTS).toPandas()
    of_grade = {r["grade"]: r["count"] for r in table.groupBy("grade").count().collect()}
    n = sum(of_grade.values())
    chosen = np.zeros(BUCKETS, bool)
    chosen[[REPEATS, DISTINCT]] = True
    for k in range(classes - 1):
        above = sum(m for grade, m in of_grade.items() if grade > k)
        if 0 < above < n:
            total, square, having = (rows[c].to_numpy() for c in ("s1", "s2", f"s{3 + k}"))
            spread = np.sqrt(np.maximum(square / n - (total / n) ** 2, 1e-12) * (above / n) * (1 - above / n))
            r = (having - total * (above / n)) / n / np.maximum(spread, 1e-12)
            # rounding may differ from fit's, which decides; here what is close passes
            chosen[rows["place"].to_numpy()[np.abs(r) * np.sqrt(n) >= LEAST_Z * (1 - 1e-6)]] = True
    return chosen


def train(docs: DataFrame, ratings: DataFrame, classes: int, id_col: str = "doc_id", text_col: str = "text", most_per_class: int = MOST_PER_CLASS) -> Model:
    """Fit on a bounded sample of ``ratings`` (doc_id, grade), one text per id: of several the one of smallest digest.

    Tasks extract the features and choose among them; the driver gets the chosen ones.
    """
    sample = labelled_sample(docs, ratings, classes, id_col, text_col, most_per_class)
    first = F.min(F.struct(F.sha2("text", 256).alias("digest"), "text", "grade")).alias("first")
    once = sample.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(first).select("doc_id", "first.text", "first.grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for i in range(batch.num_rows):
                name, text, grade = (c[i].as_py() for c in batch.columns)
                places, shares = features(text, known)
                cells = zip((name, grade, places.tobytes(), shares.tobytes()), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in cells], ["doc_id", "grade", "places", "shares"])

    scratch = Scratch(docs.sparkSession, "quality")
    found = once.mapInArrow(run, _FEATURES).filter(F.octet_length("places") > 0)
    table = scratch.write(found, "features")
    shared = docs.sparkSession.sparkContext.broadcast(_chosen(table, classes))  # BUCKETS flags

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for places, shares in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                places, shares = np.frombuffer(places, np.int32), np.frombuffer(shares, np.float32)
                used = shared.value[places]
                kept.append((places[used].tobytes(), shares[used].tobytes()))
            cells = [pa.array([k[i] for k in kept], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *cells], batch.schema.names)

    taken = table.mapInArrow(narrow, _FEATURES).toPandas().sort_values("doc_id")  # most_per_class texts of chosen features
    scratch.release(table)
    rows = [(np.frombuffer(p, np.int32), np.frombuffer(s, np.float32)) for p, s in zip(taken["places"], taken["shares"], strict=True)]
    return fit(rows, taken["grade"].to_numpy(), classes)


_FEATURES = "doc_id long, grade int, places binary, shares binary"


def score(docs: DataFrame, model: Model, least_grade: int = 1, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, expected_grade, tail (probability of ``least_grade`` or more), kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, known = shared.value.thresholds, Words()
        used = np.flatnonzero(shared.value.weights)
        weights = shared.value.weights[used].astype(np.float64)
        # of a text's features only those with a weight are looked at; all others are counted in a last cell
        cell = np.full(BUCKETS + 1, len(used), np.int64)
        cell[used] = np.arange(len(used))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                expected, tail = [], []
                for text in rows.column(1).to_pylist():
                    words, above = text.split(), np.zeros(len(cuts))
                    if words:
                        places, counts = known.counted(words)
                        total = np.bincount(cell[places], counts, len(used) + 1)[:-1]
                        above = sigmoid((weights * np.sqrt(total / len(words))).sum() - cuts)
                    expected.append(float(above.sum()) if np.isfinite(cuts).all() else 0.0)
                    tail.append(float(above[least_grade - 1]))
                cells = [rows.column(0), pa.array(expected, pa.float64()), pa.array(tail, pa.float64())]
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "expected_grade", "tail"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, expected_grade double, tail double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "tail", (F.col("tail") >= threshold).alias("kept"))


def given_grades(labels: DataFrame) -> DataFrame:
    """Three grades from the labels: poor, well written but toxic, well written."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.cast("int").alias("grade"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels' grades and score all documents."""
    return score(docs, train(docs, given_grades(labels), 3))

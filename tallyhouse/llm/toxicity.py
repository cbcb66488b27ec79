"""Toxicity by multiple-instance learning.

A document is a bag of sentences; its label says that some sentence is toxic, not which. Each sentence has
a probability from hashed words and word beginnings, and the document's is their noisy-or,
1 - product(1 - p). A sentence without evidence has probability 0 exactly, so that a long document does not
become toxic by its length. Training moves the sentences' scores through that product, so it finds by itself which
sentences carry the label, and scoring returns the worst one's place in the text.

The model is fitted by the driver on a bounded sample of labelled documents (``MOST_PER_CLASS`` of each
label, never a held-out one). Tasks count the sample's features and extract those that tell its labels apart; every document is scored in full by tasks. A
word's score is the sum of its features' weights, so a sentence takes one look-up per word.

A sentence ends at ``.``, ``!``, ``?`` or a line's end, and after ``MOST_WORDS`` words.

Defined results: null, empty and blank texts have no sentence, score 0 and no worst sentence. Rows that
repeat a doc_id are scored each for itself. Without labels of both kinds every score is 0. An empty table gives
an empty result. Label, language, source and id are no inputs of a score; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, bounded_batches, whole_text, with_row_key, without_rows
from tallyhouse.llm.training import BUCKETS, MOST_PER_CLASS, Adam, associated_counts, held_out, labelled_sample, place, sigmoid

MOST_WORDS = 40
#: Log-odds of a sentence without evidence; what is above them counts.
REST = -4.0
CACHE_WORDS = 500_000
_SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
_WORD = re.compile(r"\S+")
_NO_LETTER = re.compile(r"[\W\d_]+")


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct words as written) of each sentence."""
    for found in _SENTENCE.finditer(text):
        words = found.group().split()
        if len(words) <= MOST_WORDS:
            if words:
                yield found.start(), found.end(), set(words)
            continue
        places = [m.span() for m in _WORD.finditer(text, found.start(), found.end())]
        for at in range(0, len(places), MOST_WORDS):
            some = places[at : at + MOST_WORDS]
            yield some[0][0], some[-1][1], {text[a:b] for a, b in some}


def features(word: str) -> list[int]:
    """Places of a word and its beginnings; none for a word without letters."""
    letters = _NO_LETTER.sub("", word.lower())
    if not letters:
        return []
    return [place("=" + letters)] + [place(letters[:n]) for n in range(3, min(8, len(letters)) + 1)]


def probability(z: np.ndarray) -> np.ndarray:
    """Of sentences whose evidence adds up to ``z``: 0 for none, rising to 1."""
    rest = sigmoid(np.float64(REST))
    return np.clip((sigmoid(z + REST) - rest) / (1 - rest), 0.0, 1 - 1e-12)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray


def fit(bags: list[list[np.ndarray]], labels: np.ndarray, rounds: int = 200, decay: float = 1e-4) -> Model:
    """Noisy-or logistic model of documents given as the features of their sentences that have any."""
    some = np.array([bool(b) for b in bags], bool)
    weights = np.zeros(BUCKETS, np.float32)
    if not some.any() or len(set(labels.tolist())) < 2:
        return Model(weights)
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())[some]
    bags, labels = [b for b in bags if b], labels[some]
    every = [s for b in bags for s in b]
    of_sentence = np.repeat(np.arange(len(every)), [len(s) for s in every])
    of_document = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    first = np.flatnonzero(np.r_[True, np.diff(of_document) != 0])
    used, flat = np.unique(np.concatenate(every), return_inverse=True)
    values = {"w": np.zeros(len(used))}
    adam = Adam()
    for _ in range(rounds):
        z = np.bincount(of_sentence, values["w"][flat], len(every))
        clean = np.exp(np.add.reduceat(np.log1p(-probability(z)), first))  # product of 1 - p
        pull = np.where(labels == 1, -clean / np.maximum(1 - clean, 0.05), 1.0) * share
        # slope of the loss in z: the factor 1 / (1 - p) of the product cancels one of the sigmoid's
        slope = np.where(z >= 0, sigmoid(z + REST), 0.0) * pull[of_document]
        adam.update(values, {"w": np.bincount(flat, slope[of_sentence], len(used)) + decay * values["w"]})
    weights[used] = values["w"]
    return Model(weights)


def _chosen(sample: DataFrame) -> np.ndarray:
    """Which features tell toxic documents from others; tasks count, a row per feature and label comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                text, grade = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                met = {f for word in set(text.split()) for f in features(word)}
                counts[grade, list(met)] += 1
        grade, feature = np.nonzero(counts)
        cells = [pa.array(grade, pa.int32()), pa.array(feature, pa.int32()), pa.array(counts[grade, feature])]
        yield pa.RecordBatch.from_arrays(cells, ["grade", "feature", "n"])

    counted = sample.select("text", "grade").mapInArrow(run, "grade int, feature int, n long")
    rows = counted.groupBy("grade", "feature").agg(F.sum("n").alias("n")).toPandas()  # 2 * BUCKETS at most
    found = np.zeros((2, BUCKETS))
    found[rows["grade"], rows["feature"]] = rows["n"]
    documents = {r["grade"]: r["count"] for r in sample.groupBy("grade").count().collect()}
    return associated_counts(found[0], found[1], documents.get(0, 0), documents.get(1, 0))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_per_class: int = MOST_PER_CLASS) -> Model:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    grades = labels.select("doc_id", F.col("toxic").cast("int").alias("grade")).filter("grade IN (0, 1)")
    sample = scratch.write(labelled_sample(docs, grades, 2, id_col, text_col, most_per_class), "sample")
    shared = docs.sparkSession.sparkContext.broadcast(_chosen(sample))  # BUCKETS flags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                name, text, grade = (c[i].as_py() for c in batch.columns)
                # by sorted word, so that the order does not depend on a set
                bag = [[f for w in sorted(words) for f in features(w) if chosen[f]] for _, _, words in sentences(text)]
                bag = [np.array(b, np.int32) for b in bag if b]
                sizes = np.array([len(b) for b in bag], np.int32).tobytes()
                packed = np.concatenate(bag).tobytes() if bag else b""
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                cells = [pa.array([x], kind) for x, kind in zip((name, grade, sizes, packed), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "grade", "sizes", "features"])

    found = sample.select(F.col("doc_id").cast("long"), "text", "grade").mapInArrow(run, "doc_id long, grade int, sizes binary, features binary")
    rows = found.toPandas().sort_values(["doc_id", "features"])  # bounded by most_per_class
    scratch.release(sample)
    bags = [
        np.split(np.frombuffer(f, np.int32), np.cumsum(np.frombuffer(s, np.int32))[:-1]) if s else []
        for s, f in zip(rows["sizes"], rows["features"], strict=True)
    ]
    return fit(bags, rows["grade"].to_numpy())


SCORED = "doc_id long, score double, worst_start int, worst_end int, worst_score double"


class Scorer:
    """Scores texts in a task; words' scores are remembered."""

    def __init__(self, model: Model) -> None:
        self._model = model
        self._known: dict[str, float] = {}

    def _of_word(self, word: str) -> float:
        value = self._known.get(word)
        if value is None:
            if len(self._known) >= CACHE_WORDS:
                self._known.clear()
            value = self._known[word] = float(self._model.weights[features(word)].sum())
        return value

    def __call__(self, text: str) -> tuple[float, int | None, int | None, float | None]:
        """Noisy-or of the sentences, and start, end and probability of the worst one."""
        places, z = [], []
        for start, end, words in sentences(text):
            places.append((start, end))
            # sorted: the sum must not depend on the order of a set
            z.append(sum(sorted(filter(None, map(self._of_word, words)))))
        if not z:
            return 0.0, None, None, None
        p = probability(np.array(z, float))
        worst = int(p.argmax())
        total = -np.expm1(np.log1p(-p).sum())
        return float(min(max(total, 0.0), 1.0)), *places[worst], float(p[worst])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of each whole text, and place (code points) and score of its worst sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                found = [scorer(text) for text in rows.column(1).to_pylist()]
                kinds = [pa.float64(), pa.int32(), pa.int32(), pa.float64()]
                cells = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *cells], ["doc_id", "score", "worst_start", "worst_end", "worst_score"]
                )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, SCORED)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` with all their columns, less those that score ``threshold`` or more.

    Texts go to Python in bounded batches and do not come back: what is written is the numbers of rows that leave.
    """
    keyed, key = with_row_key(docs)
    toxic = score(keyed, model, key, text_col).filter(F.col("score") >= threshold)
    with bounded_batches(docs.sparkSession):
        return without_rows(keyed, toxic.select(F.col("doc_id").alias(key)), key)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, most_per_class: int = MOST_PER_CLASS) -> DataFrame:
    """Train and score: doc_id, held_out, score, predicted, and the worst sentence."""
    model = train(docs, labels, most_per_class=most_per_class)
    scored = score(docs, model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score",
    )

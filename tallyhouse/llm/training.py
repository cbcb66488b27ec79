"""What the two trained operators share: a bounded sample of labelled documents, hashed features, Adam."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import whole_text

#: Weights; a feature's place is its crc32 modulo this.
BUCKETS = 1 << 18
#: Documents that a model is fitted on at most, per class of the label.
MOST_PER_CLASS = 3000
#: A document is held out of training when the crc32 of its id as text leaves 0 modulo this.
FOLDS = 5


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is never learned from; a null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def place(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def labelled_sample(
    docs: DataFrame, grades: DataFrame, classes: int, id_col: str = "doc_id", text_col: str = "text",
    most_per_class: int = MOST_PER_CLASS,
) -> DataFrame:
    """(text, grade) of labelled documents that are not held out, ``most_per_class`` of each grade at most.

    ``grades`` has doc_id and grade, 0 to ``classes`` - 1; of several grades of a document the highest counts.
    Which documents are taken follows a hash of their ids, so reruns agree. The broadcast ids are bounded
    by the two parameters.
    """
    once = grades.filter(~held_out("doc_id") & F.col("grade").isNotNull()).groupBy("doc_id").agg(F.max("grade").alias("grade"))
    taken = None
    for grade in range(classes):
        some = once.filter(F.col("grade") == grade).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class)
        taken = some if taken is None else taken.union(some)
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return texts.join(F.broadcast(taken), "doc_id").select("doc_id", "text", "grade")


#: Least strength of a feature's correlation with the label, in standard deviations of chance.
LEAST_Z = 4.0
#: Documents of the sample in which a feature occurs at least.
LEAST_DOCUMENTS = 8


def associated(owner: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` features correlate with ``target`` beyond chance, each document naming a feature once.

    Invented and rare words would let a model learn documents by heart; this leaves what recurs.
    """
    n = len(target)
    t = target - target.mean()
    total, square = np.bincount(feature, value, size), np.bincount(feature, value * value, size)
    spread = np.sqrt(np.maximum(square / n - (total / n) ** 2, 1e-12) * (t * t).mean())
    r = np.bincount(feature, value * t[owner], size) / n / np.maximum(spread, 1e-12)
    return (np.abs(r) * np.sqrt(n) >= LEAST_Z) & (np.bincount(feature, minlength=size) >= LEAST_DOCUMENTS)


def associated_counts(without: np.ndarray, having: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """The same for features that a document has or not, from the documents of either label that have them."""
    n = n0 + n1
    if not n0 or not n1:
        return np.zeros(len(having), bool)
    share, of_label = (without + having) / n, n1 / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * of_label * (1 - of_label))
    z = np.abs(having / n - share * of_label) / spread * np.sqrt(n)
    return (z >= LEAST_Z) & (without + having >= LEAST_DOCUMENTS)


class Adam:
    """Full-batch Adam over named arrays."""

    def __init__(self, rate: float = 0.05) -> None:
        self._rate, self._step, self._m, self._v = rate, 0, {}, {}

    def update(self, values: dict[str, np.ndarray], slopes: dict[str, np.ndarray]) -> None:
        self._step += 1
        for name, slope in slopes.items():
            m = self._m[name] = 0.9 * self._m.get(name, 0.0) + 0.1 * slope
            v = self._v[name] = 0.99 * self._v.get(name, 0.0) + 0.01 * slope * slope
            m, v = m / (1 - 0.9**self._step), v / (1 - 0.99**self._step)
            values[name] -= self._rate * m / (np.sqrt(v) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))

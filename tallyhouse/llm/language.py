"""Language identification with spans of mixed-language text.

Every word gets a score per language. The script of its letters narrows the candidates: a language in whose
texts a script hardly occurs is out for words of that script. Among the candidates its letter sequences (one
to four, edges included) and the word itself count, by the logarithm of their share in each language, averaged
over the five kinds, less the mean of all languages. The best path through the words (Viterbi), with a penalty for
each change of language, labels spans; the language with most letters is the document's.

Most texts are in one language throughout. That is certain, without following paths, if no run of words anywhere
gains more than one penalty by another language; it takes a running sum. All other texts go through
Viterbi side by side, one step for all of them at a time.

The model is a table of shares in hashed places, learned in tasks from about ``PER_LANGUAGE`` documents of each
language, drawn by a digest of text and id; what tasks send is a count per language and place, whatever the
number of documents. Each worker keeps the scores of words it has met; the cache is bounded and only saves time.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text when no
language is learned. The score is the share of letters in the predicted language times the language's
probability over the words that have it. Ties go to the first language in code-point order. Rows that repeat an id, or have
none, are documents of their own; a null id is not held out. A row with null text teaches nothing. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Scratch, quoted

UNKNOWN = "und"
#: A document is held out of training when the crc32 of its id as text leaves ``HELD_OUT`` modulo ``FOLDS``.
FOLDS, HELD_OUT = 3, 1
#: Documents of a language that are learned from, about.
PER_LANGUAGE = 2000
#: Places of each kind of feature: sequences of one to four letters, and whole words.
PLACES, LONGEST = 1 << 15, 4
#: Weight of all languages' mean share in each, and the share that counts as nothing.
SHARED, NOTHING = 0.1, 1e-6
#: A word's score is at most this far from the mean; a word outside a language's scripts has ``OUTSIDE``.
MOST, OUTSIDE = 4.0, -20.0
#: Least share of a language's letters in a script it is written in.
LEAST_SCRIPT = 0.01
#: What a change of language costs.
SWITCH = 10.0
#: Words a worker remembers.
CACHE_WORDS = 400_000
#: Documents and words of one step.
STEP_DOCUMENTS, STEP_WORDS = 500, 1_000_000

# First and last code points of scripts in Unicode.
SCRIPTS: tuple[tuple[str, tuple[tuple[int, int], ...]], ...] = (
    ("Latin", ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F),)),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF))),
    ("Devanagari", ((0x900, 0x97F),)),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Georgian", ((0x10A0, 0x10FF),)),
    ("Hangul", ((0x1100, 0x11FF), (0xAC00, 0xD7AF))),
    ("Kana", ((0x3040, 0x30FF),)),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F))),
)
OTHER = len(SCRIPTS)
_RANGES = sorted((a, b, i) for i, (_, ranges) in enumerate(SCRIPTS) for a, b in ranges)
_STARTS, _ENDS, _NAMES = (np.array(x) for x in zip(*_RANGES, strict=True))
_BEYOND_LATIN = re.compile("[Ͱ-᷿ἀ-\U0010ffff]")


def _classes() -> tuple[list[str], str]:
    each = ["".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) for name, ranges in SCRIPTS if name != "Latin"]
    return each, "".join(each)


#: Words end at white space and, beyond Latin, where the script changes.
_WORDS = re.compile("|".join([*(f"[{c}]+" for c in _classes()[0]), rf"[^\s{_classes()[1]}]+"]))
_PLACES_IN_ALL = PLACES * (LONGEST + 1)


def held_out(doc_id: str | Column) -> Column:
    """Whether a document is never learned from."""
    column = F.col(quoted(doc_id)) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def tokens(text: str) -> list[str]:
    return _WORDS.findall(text) if _BEYOND_LATIN.search(text) else text.split()


def bare(token: str) -> str:
    """The token from its first to its last letter, in lower case; empty without a letter."""
    if not token.isalpha():
        letters = [i for i, c in enumerate(token) if c.isalpha()]
        if not letters:
            return ""
        token = token[letters[0] : letters[-1] + 1]
    return token.lower()


def scripts_of(codes: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_STARTS, codes, "right") - 1
    return np.where((at >= 0) & (codes <= _ENDS[at]), _NAMES[at], OTHER)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place) of every feature of non-empty words, as two arrays, and letters by word and script."""
    codes = np.frombuffer(f"\n{'\n'.join(words)}\n".encode("utf-32-le", "surrogatepass"), np.uint32)
    edge = codes == 10
    word_of = np.cumsum(edge) - 1
    owners, places = [], []
    for n in range(1, LONGEST + 1):
        windows = len(codes) - n + 1
        inner = np.zeros(windows, bool)
        digest = np.zeros(windows, np.uint64)
        for j in range(n):
            digest = digest * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + windows]
            if n == 1 or 0 < j < n - 1:
                inner |= edge[j : j + windows]
        at = np.flatnonzero(~inner & ~(edge[:windows] & edge[n - 1 :])) if n <= 2 else np.flatnonzero(~inner)
        spread = (digest[at] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
        owners.append(word_of[at])
        places.append((spread % np.uint64(PLACES)).astype(np.int64) + (n - 1) * PLACES)
    owners.append(np.arange(len(words)))
    whole = [zlib.crc32(w.encode("utf-8", "surrogatepass")) % PLACES for w in words]
    places.append(np.array(whole, np.int64) + LONGEST * PLACES)
    inside = np.flatnonzero(~edge)
    kinds = OTHER + 1
    letters = np.bincount(word_of[inside] * kinds + scripts_of(codes[inside]), minlength=len(words) * kinds)
    return np.concatenate(owners), np.concatenate(places), letters.reshape(len(words), kinds)


@dataclass(frozen=True)
class Model:
    """Scores of places by language, and which languages a script allows."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray

    @classmethod
    def of(cls, languages: tuple[str, ...], counts: np.ndarray) -> Model:
        """From counts by language and place, with letters by script behind the features."""
        kinds = counts[:, :_PLACES_IN_ALL].reshape(len(languages), LONGEST + 1, PLACES).astype(float)
        shares = kinds / np.maximum(kinds.sum(2, keepdims=True), 1)
        logs = np.log(shares + SHARED * shares.mean(0, keepdims=True) + NOTHING)
        scores = ((logs - logs.mean(0, keepdims=True)) / (LONGEST + 1)).reshape(len(languages), -1).T
        letters = counts[:, _PLACES_IN_ALL:].astype(float)
        allowed = letters >= LEAST_SCRIPT * np.maximum(letters.sum(1, keepdims=True), 1)
        allowed |= ~allowed.any(0, keepdims=True)  # a script that nobody uses tells nothing
        return cls(languages, np.ascontiguousarray(scores, np.float32), allowed.T)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and numbers of letters of words as :func:`bare` gives them."""
        found = np.zeros((len(words), len(self.languages)), np.float32)
        size = np.zeros(len(words), np.int64)
        named = [i for i, w in enumerate(words) if w]
        if named:
            owner, place, letters = features([words[i] for i in named])
            each = np.stack([np.bincount(owner, self.scores[place, k], len(named)) for k in range(len(self.languages))], 1)
            each = np.clip(each, -MOST, MOST)
            each[~self.allowed[letters.argmax(1)]] = OUTSIDE
            found[named], size[named] = each, letters.sum(1)
        return found, size


def best_paths(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """The language of each word on the best path of every document, all documents step by step together."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    flat = np.concatenate([scores[i] for i in order]).astype(np.float64)
    every = np.arange(flat.shape[1])
    came_from = np.empty(flat.shape, np.int32)
    value = flat[starts].copy()
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # documents longer than the step
    for t in range(1, steps):
        n = active[t]
        now = value[:n]
        best = now.argmax(1)
        changed = now[np.arange(n), best] - switch
        stays = now >= changed[:, None]
        at = starts[:n] + t
        came_from[at] = np.where(stays, every, best[:, None])
        value[:n] = np.where(stays, now, changed[:, None]) + flat[at]
    path = np.empty(len(flat), np.int32)
    label = value.argmax(1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = label[:n]
        if t:
            label[:n] = came_from[at, label[:n]]
    result: list[np.ndarray] = [np.empty(0)] * len(scores)
    for i, a, n in zip(order, starts, lengths, strict=True):
        result[i] = path[a : a + n]
    return result


def single_language(scores: np.ndarray, switch: float) -> int | None:
    """The language of all words, if it is sure that no change pays: no run of words gains more than a penalty."""
    best = int(scores.sum(0).argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], 0, dtype=np.float64)
    lowest = np.minimum(np.minimum.accumulate(gain, 0), 0)
    most = max(float((gain[1:] - lowest[:-1]).max(initial=0.0)), float(gain[0].max()))
    return best if most <= switch else None


class Labeller:
    """Texts to spans, with the words met before."""

    def __init__(self, model: Model, most_words: int = CACHE_WORDS) -> None:
        self.model = model
        self._most = most_words
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self._letters = np.zeros(1024, np.int64)

    def _learn(self, missing: list[str]) -> None:
        scores, letters = self.model.words([bare(w) for w in missing])
        at = len(self._known)
        while at + len(missing) > len(self._letters):
            self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
            self._letters = np.concatenate([self._letters, np.zeros_like(self._letters)])
        self._scores[at : at + len(missing)], self._letters[at : at + len(missing)] = scores, letters
        self._known.update(zip(missing, range(at, at + len(missing)), strict=True))

    def rows(self, texts: list[str | None]) -> list[tuple[list[tuple[int, int, str]] | None, str, float]]:
        """(spans in characters, language, score) of each text."""
        result: list[tuple[list[tuple[int, int, str]] | None, str, float]] = []
        at = 0
        while at < len(texts):
            words: list[list[str]] = []
            held = 0
            while at + len(words) < len(texts) and len(words) < STEP_DOCUMENTS and held < STEP_WORDS:
                text = texts[at + len(words)]
                words.append(tokens(text) if text else [])
                held += len(words[-1])
            result += self._step(texts[at : at + len(words)], words)
            at += len(words)
        return result

    def _step(self, texts: list[str | None], words: list[list[str]]) -> list:
        get = self._known.get
        ids = [list(map(get, w)) for w in words]
        missing = {w for some, found in zip(words, ids, strict=True) if None in found for w, i in zip(some, found, strict=True) if i is None}
        if missing:
            if self._known and len(self._known) + len(missing) > self._most:
                self._forget()
                missing = {w for some in words for w in some}
                ids = [[None] * len(w) for w in words]
            self._learn(sorted(missing))
            get = self._known.get
            ids = [list(map(get, w)) if None in i else i for w, i in zip(words, ids, strict=True)]
        told: list = [(None, UNKNOWN, 0.0)] * len(texts)
        mixed = []
        for d, row in enumerate(ids):
            at = np.array(row, np.int64)
            letters = self._letters[at]
            if not letters.any():
                continue
            scores = self._scores[at]
            alone = single_language(scores, SWITCH)
            if alone is None:
                mixed.append((d, scores, letters))
            else:
                told[d] = ([(0, len(texts[d]), self.model.languages[alone])], *self._verdict(scores, letters, np.full(len(at), alone)))
        if mixed:
            for (d, scores, letters), path in zip(mixed, best_paths([s for _, s, _ in mixed], SWITCH), strict=True):
                told[d] = (self._spans(texts[d], path), *self._verdict(scores, letters, path))
        return told

    def _verdict(self, scores: np.ndarray, letters: np.ndarray, path: np.ndarray) -> tuple[str, float]:
        of = np.bincount(path, letters, len(self.model.languages))
        chosen = int(of.argmax())
        total = scores[path == chosen].sum(0, dtype=np.float64)
        chances = np.exp(total - total.max())
        return self.model.languages[chosen], float(of[chosen] / of.sum() * chances[chosen] / chances.sum())

    def _spans(self, text: str, path: np.ndarray) -> list[tuple[int, int, str]]:
        changes = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist()]
        if len(changes) == 1:
            return [(0, len(text), self.model.languages[path[0]])]
        pattern = _WORDS if _BEYOND_LATIN.search(text) else re.compile(r"\S+")
        begins = [m.start() for m in pattern.finditer(text)]
        borders = [0, *(begins[i] for i in changes[1:]), len(text)]
        return [(a, b, self.model.languages[path[i]]) for a, b, i in zip(borders, borders[1:], changes, strict=False)]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """The model of the documents that name their language and are not held out."""
    named = docs.select(
        F.col(quoted(id_col)).cast("string").alias("id"), F.col(quoted(text_col)).alias("text"), F.col(quoted(lang_col)).cast("string").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id"))
    scratch = Scratch(docs.sparkSession, "languages")
    sizes = scratch.write(named.groupBy("lang").agg(F.count("*").alias("n")), "sizes")  # a row per language
    languages = tuple(sorted(r["lang"] for r in sizes.collect()))
    if not languages:
        scratch.release(sizes)
        return None
    number = {name: i for i, name in enumerate(languages)}
    draw = F.pmod(F.xxhash64("text", "id"), F.lit(1 << 30)) < F.least(F.lit(1.0), per_language / F.col("n")) * (1 << 30)
    sample = named.join(F.broadcast(sizes), "lang").filter(draw).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            met: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                met.setdefault(lang, Counter()).update(tokens(text))
            for lang, words in met.items():
                bared: Counter = Counter()
                for token, n in words.items():
                    bared[bare(token)] += n
                bared.pop("", None)
                if not bared:
                    continue
                owner, place, letters = features(list(bared))
                times = np.array(list(bared.values()), float)
                now = np.concatenate([np.bincount(place, times[owner], _PLACES_IN_ALL), times @ letters])
                counts[lang] = counts[lang] + now if lang in counts else now
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            cells = [pa.array(np.full(len(at), number[lang], np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cells, ["lang", "place", "n"])

    summed = sample.mapInArrow(run, "lang int, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # at most a row per language and place
    scratch.release(sizes)
    counts = np.zeros((len(languages), _PLACES_IN_ALL + OTHER + 1))
    counts[found["lang"].to_numpy(), found["place"].to_numpy()] = found["n"].to_numpy()
    return Model.of(languages, counts)


RESULT = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of every document; spans are in characters, null without letters."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(quoted(text_col)).alias("text"))
    if model is None:
        spans = F.lit(None).cast("array<struct<start: int, end: int, lang: string>>")
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), spans.alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # places x languages numbers
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_DOCUMENTS):
                part = batch.slice(at, STEP_DOCUMENTS)
                told = label.rows(part.column(2).to_pylist())
                spans = [s and [{"start": a, "end": b, "lang": c} for a, b, c in s] for s, _, _ in told]
                cells = [part.column(0), part.column(1), pa.array([x for _, x, _ in told], pa.string()), pa.array([x for _, _, x in told], pa.float64()), pa.array(spans, span)]
                yield pa.RecordBatch.from_arrays(cells, ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, RESULT)

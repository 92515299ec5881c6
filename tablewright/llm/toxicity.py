"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other: each model sees the words of a document
and the log odds of all earlier categories. For training, those come out of fold (FOLDS
models that have not seen the document), so a later model learns how far to trust them; for
scoring they come from the models trained on all folds. The last category is `toxic`.

The labels are `labels.toxic`; the earlier categories are weak labels, toxic documents with
a word of a short public list each. Words are lower-cased runs of letters; a document also
has the beginnings of its words (of PREFIXES bytes), which many inflected words share. The
models know the VOCABULARY words and beginnings of greatest chi-square (toxic or not, by
documents) in the training sample, counted in Spark. The sample has at most `sample` labelled documents, by the least
hash of doc_id; documents whose crc32(doc_id) is 0 modulo 5 are held out.

Null text is empty. With under MIN_LABELS labels or one class only, a category's score is
its smoothed share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .quality import KIND, MIN_LABELS, held_out, sampled_labels

#: Weak categories and their words; any others may be given.
CATEGORIES = {"insult": ("clown", "idiot", "loser", "moron", "scum"), "contempt": ("disgusting", "pathetic", "stupid", "trash", "worthless")}
SAMPLE = 20_000
VOCABULARY = 1 << 13
PREFIXES = (4, 5, 6, 7, 8, 10)
FOLDS = 5
STEPS = 120
THRESHOLD = 0.2


def word_hashes(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct hashes of the words (runs of letters, lower-cased A-Z) of each text and of their beginnings."""
    data, offsets = T.buffers(texts)
    for a, b in T.blocks(offsets):
        part, at = T.LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        letter = np.concatenate(([False], KIND[part] == 1, [False]))
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[at] = True
        start = np.flatnonzero(letter[1:-1] & (~letter[:-2] | edge[:-1]))
        end = np.flatnonzero(letter[1:-1] & (~letter[2:] | edge[1:])) + 1
        first = np.searchsorted(start, at)
        found = [(T.spans(part, start, end), first)]
        for k in PREFIXES:
            long = end - start > k
            before = np.concatenate(([0], np.cumsum(long)))
            found.append((T.mix(T.spans(part, start[long], start[long] + k) + T.U(k)), before[first]))
        for i in range(b - a):
            yield np.unique(np.concatenate([h[f[i] : f[i + 1]] for h, f in found]))


def known_words(word: str) -> int:
    """The hash of a word as a whole."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(T.spans(data, np.array([0]), np.array([len(data)]))[0])


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    chosen = sampled_labels(labels, "toxic", sample)  # at most `sample` small rows
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")


def vocabulary(known: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """Hashes of the words that tell toxic from other documents, sorted."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = list(word_hashes(batch.column("text")))
            label = np.repeat(batch.column("label").to_numpy(), [len(w) for w in words])
            yield pa.RecordBatch.from_arrays([pa.array(T.signed(np.concatenate(words)) if words else [], pa.int64()), pa.array(label, pa.int64())], names=["word", "toxic"])

    total = known.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, t = float(total.n), float(total.t or 0)
    counts = known.mapInArrow(task, "word long, toxic long").groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).where("n >= 2")
    gap = F.col("t") * n - F.col("n") * t
    best = counts.select("word", (gap * gap / (F.col("n") * (n - F.col("n")) + 1)).alias("chi")).orderBy(F.desc("chi"), "word").limit(size)
    return np.sort(np.array([r.word for r in best.collect()], dtype=np.int64).view(T.U))


def features(texts: pa.Array, words: np.ndarray, weak: list[np.ndarray]) -> list[tuple[np.ndarray, list[bool]]]:
    """Places of a text's words in the vocabulary, and whether it has a word of each weak list."""
    out = []
    for hashes in word_hashes(texts):
        at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
        found = at[words[at] == hashes] if len(words) else at[:0]
        out.append((found.astype(np.int32), [bool(np.isin(hashes, w).any()) for w in weak]))
    return out


class Linear:
    """Logistic regression over word presence and dense inputs, by full-batch steps."""

    def __init__(self, at: np.ndarray, first: np.ndarray, dense: np.ndarray, y: np.ndarray, size: int):
        self.prior, self.words = (y.sum() + 1) / (len(y) + 2), None
        if len(y) < MIN_LABELS or not 0 < y.sum() < len(y):
            return
        words, rest, m, v = np.zeros(size), np.zeros(dense.shape[1] + 1), 0, 0
        rest[-1] = np.log(self.prior / (1 - self.prior))
        row, dense = np.repeat(np.arange(len(y)), np.diff(first)), np.column_stack([dense, np.ones(len(y))])
        for t in range(1, STEPS + 1):
            error = _odds(_margin(words, at, row, len(y)) + dense @ rest) - y
            g = np.concatenate([np.bincount(at, error[row], size), dense.T @ error]) / len(y) + 1e-5 * np.concatenate([words, rest])
            m, v = m + 0.1 * (g - m), v + 0.001 * (g * g - v)
            step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            words, rest = words - step[:size], rest - step[size:]
        self.words, self.rest = words, rest

    def margin(self, at: np.ndarray, first: np.ndarray, dense: np.ndarray) -> np.ndarray:
        n = len(first) - 1
        if self.words is None:
            return np.full(n, np.log(self.prior / (1 - self.prior)))
        return _margin(self.words, at, np.repeat(np.arange(n), np.diff(first)), n) + dense @ self.rest[:-1] + self.rest[-1]


def _margin(words: np.ndarray, at: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, words[at], n)


def _odds(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _rows(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.int32)), np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(int)


class Chain:
    """One Linear per category, in order; each takes the margins of those before it."""

    def __init__(self, names: list[str], found: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, size: int):
        self.names, self.models = names, []
        at, first = _rows(found)
        dense = np.zeros((len(found), 0))
        for k in range(len(names)):
            y, outside = labels[:, k], np.zeros(len(found))
            for fold in range(FOLDS if k + 1 < len(names) else 0):
                rest, own = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
                model = Linear(*_rows([found[i] for i in rest]), dense[rest], y[rest], size)
                outside[own] = model.margin(*_rows([found[i] for i in own]), dense[own])
            self.models.append(Linear(at, first, dense, y, size))
            dense = np.column_stack([dense, np.clip(outside, -8, 8)])

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        at, first = _rows(found)
        dense = np.zeros((len(found), 0))
        for model in self.models:
            dense = np.column_stack([dense, np.clip(model.margin(at, first, dense), -8, 8)])
        return _odds(dense)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, ...]] = CATEGORIES, sample: int = SAMPLE) -> tuple[np.ndarray, Chain]:
    known = _sample(docs, labels, sample)
    words = vocabulary(known)
    weak = [np.array([known_words(w) for w in ws], dtype=T.U) for ws in categories.values()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column("text"), words, weak)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([f.tobytes() for f, _ in found], pa.binary()), pa.array([w for _, w in found], pa.list_(pa.bool_()))], names=["doc_id", "label", "words", "weak"])

    # At most `sample` rows of at most VOCABULARY numbers.
    rows = known.mapInArrow(task, "doc_id long, label int, words binary, weak array<boolean>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.words))
    y = np.array([[r.label and w for w in r.weak] + [r.label] for r in rows], dtype=float).reshape(len(rows), -1 if rows else len(weak) + 1)
    folds = (T.mix(np.array([r.doc_id for r in rows], dtype=np.int64).view(T.U)) % T.U(FOLDS)).astype(int)
    return words, Chain([*categories, "toxic"], [np.frombuffer(r.words, dtype=np.int32) for r in rows], y, folds, max(len(words), 1))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """doc_id, held_out, p_<category> for each category of the chain, is_toxic (p_toxic >= threshold)."""
    words, chain = train(docs, labels, **how)
    shared = docs.sparkSession.sparkContext.broadcast((words, chain))
    names = [f"p_{n}" for n in chain.names]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, chain = shared.value
        for batch in batches:
            scores = np.round(chain.scores([f for f, _ in features(batch.column("text"), words, [])]), 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(scores[:, k]) for k in range(len(names)))], names=["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return rows.select("doc_id", held_out().alias("held_out"), *names, (F.col("p_toxic") >= threshold).alias("is_toxic"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

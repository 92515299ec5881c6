"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

A word here is a run of letters, of digits or of other characters; it is hashed into one of
VOCABULARY rows. Every row has a fixed sparse random index vector. The word vectors are the
sums, over all documents, of the index vectors of the words up to two places away (counted
in Spark, one VOCABULARY x SIZE matrix of integers per task, added up by row block). A
document is the mean and the deviation of its word vectors, weighted down for frequent
words, with the mean vector of the words' shapes, the length, and how often a word comes
again one or two places later.

The network (one hidden layer) is trained in numpy on at most SAMPLE labelled documents,
taken by the least hash of doc_id; the bound is the parameter `sample`. A tenth of them is
kept back to calibrate the temperature of the probabilities. The model is a few MB whatever
the corpus, and is broadcast for scoring.

Null text is empty and gets the score of a document without words. Labels that are null
count as missing, several labels of one doc_id by their mean. With under MIN_LABELS labels
or one class only, the score is the smoothed share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import text as T

VOCABULARY = 1 << 14
SIZE = 64
NONZERO = 4
SAMPLE = 20_000
MIN_LABELS = 20
THRESHOLD = 0.3
HIDDEN = 32
EPOCHS = 40
#: The last rows of the vocabulary stand for shapes: lower case, Capital, UPPER, mixed, digits, other.
SHAPES = 8
CHUNK = 1 << 12
FEATURES = 3 * SIZE + 4

_draw = np.random.Generator(np.random.PCG64(11))
PLACES = _draw.integers(0, SIZE, (VOCABULARY, NONZERO))
SIGNS = _draw.integers(0, 2, (VOCABULARY, NONZERO)) * 2 - 1
INDEX = np.zeros((VOCABULARY, SIZE), dtype=np.float32)
np.add.at(INDEX, (np.arange(VOCABULARY)[:, None], PLACES), SIGNS)

KIND = np.full(256, 3, dtype=np.uint8)
KIND[T.SPACE] = 0
KIND[48:58] = 2
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary row and shape row of each word, and first word of each text."""
    kind = KIND[data]
    cut = np.ones(len(data) + 1, dtype=bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[offsets] = True
    start = np.flatnonzero(cut)[:-1]
    end = np.flatnonzero(cut)[1:]
    solid = kind[start] > 0 if len(start) else np.zeros(0, dtype=bool)
    start, end = start[solid], end[solid]
    row = (T.spans(data, start, end) % T.U(VOCABULARY - SHAPES)).astype(np.int64)
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data < 91))))
    capitals = upper[end] - upper[start]
    first = data[start] if len(start) else np.zeros(0, dtype=np.uint8)
    head = (first >= 65) & (first < 91)
    shape = np.where(capitals == 0, 0, np.where((capitals == end - start) & (capitals > 1), 2, np.where(head & (capitals == 1), 1, 3)))
    shape = np.where(kind[start] == 1, shape, kind[start] + 2) if len(start) else shape
    return row, VOCABULARY - SHAPES + shape.astype(np.int64), np.searchsorted(start, offsets)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of index vectors of neighbours for each vocabulary row, and its count, in blocks of 256 rows."""
    total = np.zeros(VOCABULARY * SIZE, dtype=np.int64)
    seen = np.zeros(VOCABULARY, dtype=np.int64)

    def add(word: np.ndarray, other: np.ndarray) -> None:
        for r in range(NONZERO):
            np.add.at(total, word * SIZE + PLACES[other, r], SIGNS[other, r])

    for batch in batches:
        data, offsets = T.buffers(batch.column("text"))
        for a, b in T.blocks(offsets):
            row, shape, first = units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            seen += np.bincount(row, minlength=VOCABULARY) + np.bincount(shape, minlength=VOCABULARY)
            text = np.repeat(np.arange(b - a), np.diff(first))
            for step in (1, 2):
                same = text[step:] == text[:-step]
                left, right = row[:-step][same], row[step:][same]
                add(left, right)
                add(right, left)
                if step == 1:
                    add(left, shape[1:][same])
                    add(shape[:-1][same], right)
    if seen.any():
        blocks = total.reshape(-1, 256 * SIZE)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([x.tobytes() for x in blocks], pa.binary()), pa.array([x.tobytes() for x in seen.reshape(-1, 256)], pa.binary())], names=["block", "sums", "seen"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of one block, one at a time, as they arrive sorted by block."""
    held, names = {}, ["block", "sums", "seen"]
    for batch in batches:
        for block, sums, seen in zip(*(batch.column(n) for n in names), strict=True):
            sums, seen = (np.frombuffer(x.as_buffer(), dtype=np.int64) for x in (sums, seen))
            if held and held["block"] != block.as_py():
                yield pa.RecordBatch.from_pylist([{"block": held["block"], "sums": held["sums"].tobytes(), "seen": held["seen"].tobytes()}], schema=_BLOCKS)
                held = {}
            if held:
                held["sums"] += sums
                held["seen"] += seen
            else:
                held = {"block": block.as_py(), "sums": sums.copy(), "seen": seen.copy()}
    if held:
        yield pa.RecordBatch.from_pylist([{"block": held["block"], "sums": held["sums"].tobytes(), "seen": held["seen"].tobytes()}], schema=_BLOCKS)


_BLOCKS = pa.schema([("block", pa.int32()), ("sums", pa.binary()), ("seen", pa.binary())])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """VOCABULARY x SIZE + 1: word vectors of unit length plus their index vectors, and word weights."""
    schema = "block int, sums binary, seen binary"
    parts = docs.select("text").mapInArrow(_contexts, schema)
    # Two rounds, so that the sums of many tasks do not meet in one.
    for spread in (F.expr("pmod(hash(sums), 16)"), F.lit(0)):
        parts = parts.withColumn("_s", spread).repartition("block", "_s").sortWithinPartitions("block", "_s").drop("_s").mapInArrow(_added, schema)
    sums, seen = np.zeros((VOCABULARY // 256, 256 * SIZE)), np.zeros((VOCABULARY // 256, 256))
    for row in parts.collect():  # VOCABULARY / 256 rows, whatever the corpus
        sums[row.block] += np.frombuffer(row.sums, dtype=np.int64)
        seen[row.block] += np.frombuffer(row.seen, dtype=np.int64)
    vectors, count = sums.reshape(VOCABULARY, SIZE), seen.ravel()
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9) + INDEX / np.sqrt(NONZERO)
    weight = 1e-3 / (1e-3 + count / max(count[:-SHAPES].sum(), 1))
    weight[-SHAPES:] = 1
    return np.column_stack([vectors, weight]).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """FEATURES numbers for each text."""
    data, offsets = T.buffers(texts)
    out = np.zeros((len(offsets) - 1, FEATURES))
    # What a word adds to its document's sums, made once for each row of the vocabulary, not for each word.
    weight = vectors[:, -1:]
    words = vectors[:, :-1] * weight
    table = np.column_stack([words, words * words, weight]).astype(np.float64)
    shapes = vectors[-SHAPES:, :-1].astype(np.float64)
    for a, b in T.blocks(offsets):
        row, shape, first = units(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        n = np.diff(first).astype(float)
        doc = np.repeat(np.arange(b - a), np.diff(first))
        again = [np.bincount(doc[k:][(row[k:] == row[:-k]) & (doc[k:] == doc[:-k])], minlength=b - a) / np.maximum(n, 1) for k in (1, 2)]
        sums = np.zeros((b - a, 2 * SIZE + 1))
        # Each word of a document once, with its number.
        code = np.sort(doc * VOCABULARY + row)
        heads = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, dtype=np.int64)
        times, code = np.diff(np.append(heads, len(code))).astype(np.float64), code[heads]
        for p in range(0, len(code), CHUNK):
            docs, rows = np.divmod(code[p : p + CHUNK], VOCABULARY)
            begin = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            part = table[rows]
            part *= times[p : p + CHUNK, None]
            sums[docs[begin]] += np.add.reduceat(part, begin, axis=0)
        shaped = np.bincount(doc * SHAPES + shape - (VOCABULARY - SHAPES), minlength=(b - a) * SHAPES).reshape(-1, SHAPES) @ shapes
        mass, number = np.maximum(sums[:, -1:], 1e-9), np.maximum(n, 1)[:, None]
        mean = sums[:, :SIZE] / mass
        spread = np.sqrt(np.maximum(sums[:, SIZE : 2 * SIZE] / mass - mean * mean, 0))
        out[a:b] = np.column_stack([mean, spread, shaped / number, np.log1p(n), np.log1p(np.diff(offsets[a : b + 1])), *again])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Network:
    """Standardised features, tanh hidden layer, one logit divided by the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.prior, self.w = (y.sum() + 1) / (len(y) + 2), None
        if len(y) < MIN_LABELS or len(set(y.tolist())) < 2:
            return
        self.mean, self.std = x.mean(axis=0, dtype=np.float64), x.std(axis=0, dtype=np.float64) + 1e-6
        whole, x, order = x, np.empty(x.shape, dtype=np.float32), draw.permutation(len(y))
        for p in range(0, len(y), CHUNK):  # in parts: the numbers in between take 8 bytes each
            x[p : p + CHUNK] = (whole[p : p + CHUNK] - self.mean) / self.std
        held, used = order[: len(y) // 10], order[len(y) // 10 :]
        w = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS if len(used) > 2000 else 4 * EPOCHS):
            draw.shuffle(used)
            for p in range(0, len(used), 128):
                at, t = used[p : p + 128], t + 1
                hidden = np.tanh(x[at] @ w[0] + w[1])
                error = (_sigmoid(hidden @ w[2] + w[3]) - y[at]) / len(at)
                back = np.outer(error, w[2]) * (1 - hidden * hidden)
                for i, g in enumerate((x[at].T @ back + 1e-4 * w[0], back.sum(axis=0), hidden.T @ error + 1e-4 * w[2], error.sum(keepdims=True))):
                    m[i] += 0.1 * (g - m[i])
                    v[i] += 0.001 * (g * g - v[i])
                    w[i] -= 0.002 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.w = w
        logit = np.tanh(x[held] @ w[0] + w[1]) @ w[2] + w[3]
        tries = np.geomspace(0.5, 5, 40)
        loss = [-np.mean(y[held] * np.log(_sigmoid(logit / k) + 1e-12) + (1 - y[held]) * np.log(1 - _sigmoid(logit / k) + 1e-12)) for k in tries]
        self.temperature = tries[int(np.argmin(loss))] if len(held) >= 50 else 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), self.prior)
        hidden = np.tanh((x - self.mean) / self.std @ self.w[0] + self.w[1])
        return _sigmoid((hidden @ self.w[2] + self.w[3]) / self.temperature)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled_labels(labels: DataFrame, column: str, sample: int) -> DataFrame:
    """doc_id and label of at most `sample` rows that are not held out."""
    rows = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(column) >= 0.5).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([x.tobytes() for x in found.astype(np.float32)], pa.binary())], names=["doc_id", "label", "x"])

    # At most `sample` small rows: the bound of the broadcast.
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sampled_labels(labels, column, sample)), "doc_id")
    # As Arrow buffers: 4 bytes a feature, without an object for each row.
    rows = known.mapInArrow(task, "doc_id long, label int, x binary").toArrow()
    shared.destroy()
    rows = rows.take(pc.sort_indices(rows, [("doc_id", "ascending"), ("x", "ascending")])).combine_chunks()
    x = np.concatenate([np.frombuffer(c.cast(pa.binary(4 * FEATURES)).buffers()[1], dtype=np.float32, count=len(c) * FEATURES) for c in rows.column("x").chunks if len(c)] or [np.zeros(0, dtype=np.float32)])
    y = rows.column("label").to_numpy().astype(float)
    del rows
    return vectors, Network(x.reshape(-1, FEATURES), y)


def score(docs: DataFrame, vectors: np.ndarray, network: Network, *columns: str) -> DataFrame:
    """`columns` of docs and score, 0 to 1, rounded to six places."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))
    rows = docs.select(*columns, F.col("text").alias("_text"))
    schema = StructType([*rows.schema.fields[:-1], StructField("score", DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            found = np.round(network.score(pooled(batch.column("_text"), vectors)), 6)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found, pa.float64())], names=[*columns, "score"])

    return rows.mapInArrow(task, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= threshold) of each document."""
    vectors, network = train(docs, labels)
    rows = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), vectors, network, "doc_id")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    return classify(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

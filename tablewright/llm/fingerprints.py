"""Document fingerprints by MinHash.

A fingerprint has PERMUTATIONS 32-bit minima: for each permutation the least value of
(a * x + b) mod 2**64 >> 32 over the hashes x of the document's word shingles (a odd), in
numpy over whole batches. The likeness of two fingerprints is the share of equal minima and
estimates the Jaccard similarity of the shingle sets. Texts under `k` words have one shingle,
texts without words none: their fingerprint is all ones bits, and alike only to each other.

`near_duplicates` joins bands of the signature in Spark and verifies Jaccard on the shingle
sets; op2 has both. `edited_fingerprints` compares each document with its successor in descending doc_id:
documents go to ranges of doc_id, and the largest of each range goes along to the next
range as well, so no order over all documents is needed in one task. In op2 the components
go to the same ranges, one small row a handle, so texts are not shuffled once more.

Null text is empty. A null doc_id sorts as the smallest. Rows with one doc_id follow each
other by the hash of their text; an only document is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from . import text as T
from .linking import linked

K = 5
PERMUTATIONS = 128
BANDS = 32
NEAR = 80
_draw = np.random.Generator(np.random.PCG64(7))
A = _draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * T.U(2) + T.U(1)
B = _draw.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_LINKED = ", n_shingles long, component_id long"


def signatures(texts: pa.Array, k: int = K) -> np.ndarray:
    """Minima (rows x PERMUTATIONS, uint32) of a column of texts."""
    data, offsets = T.buffers(texts)
    out = np.full((len(offsets) - 1, PERMUTATIONS), 0xFFFFFFFF, dtype=np.uint32)
    for a, b in T.blocks(offsets, T.BLOCK // 4):
        _, _, hashes, _, first = T.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        grams, begin = T.shingles(hashes, first, k)
        rows = np.flatnonzero(np.diff(begin))
        if not len(rows):
            continue
        for p in range(0, len(grams), 1 << 15) if b - a == 1 else [0]:
            part, heads = (grams[p : p + (1 << 15)], [0]) if b - a == 1 else (grams, begin[rows])
            value = np.empty_like(part)
            for i in range(PERMUTATIONS):
                np.multiply(part, A[i], out=value)
                value += B[i]
                value >>= T.U(32)
                out[a + rows, i] = np.minimum(out[a + rows, i], np.minimum.reduceat(value, heads).astype(np.uint32))
    return out


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, handle and fingerprint of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(x) for x in signatures(batch.column("text"), k)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_id"), batch.column("_key"), pa.array(prints, pa.string())], names=["doc_id", "_id", "_key", "fingerprint"])

    return T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, _id long, _key long, fingerprint string")


def _bands(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes of a column of texts, and first band of each row; rows without shingles have none."""
    found = signatures(texts, k)
    full = (found != 0xFFFFFFFF).any(axis=1)
    wide = found.astype(np.uint64).reshape(len(found), BANDS, -1)
    value = np.zeros(wide.shape[:2], dtype=T.U) + np.arange(BANDS, dtype=T.U)
    for j in range(wide.shape[2]):
        value = T.mix(value * T.U(0x9FB21C651E98DF25) + wide[:, :, j])
    begin = np.concatenate(([0], np.cumsum(full * BANDS)))
    return value[full].ravel(), begin


def near_duplicates(docs: DataFrame, k: int = K, near: int = NEAR) -> DataFrame:
    """doc_id, n_shingles, component_id: documents linked at a Jaccard of near percent or more, among those that share a band."""
    return linked(docs, lambda texts, sets: _bands(texts, k), k=k, percent=near)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range, own rows before the guest, descending order: each own row with its successor."""
    held: tuple | None = None  # block, doc_id, text, signature, n_shingles and component_id
    handle, component = None, (None, None)  # the last row of `near_duplicates`
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles", "component_id"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def out(pairs: list[tuple]) -> pa.RecordBatch:
        edited = []
        for (_, _, text, *_), (_, _, after, *_) in pairs:
            half = len(text) // 2
            edited.append(text[: len(text) - half] + after[:half])
        prints = signatures(pa.array(edited, pa.large_string()))
        rows = [
            (doc, len(text), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), as_text(own), as_text(p), likeness(own, p), likeness(own, after), *found)
            for ((_, doc, text, own, found), (_, _, _, after, _)), e, p in zip(pairs, edited, prints, strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for p in range(0, batch.num_rows, 512):
            part = batch.slice(p, 512)
            prints, pairs = signatures(part.column("text")), []
            columns = [part.column(c).to_pylist() for c in ("code", "doc_id", "_key", "text", "kind", "n_shingles", "component_id")]
            for code, doc, key, text, kind, n, root, own in zip(*columns, prints, strict=True):
                if not kind:
                    handle, component = (doc, key), (n, root)
                    continue
                row = (code // 2, doc, text or "", own, component if handle == (doc, key) else (None, None))
                if held and held[0] == row[0]:
                    pairs.append((held, row))
                held = None if code % 2 else row
            if pairs:
                yield out(pairs)


def edited_fingerprints(docs: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Each document with its edited text (see op2) and the likeness to it and to its successor.

    With the rows of `near_duplicates`, n_shingles and component_id of the document as well.
    """
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    rows = T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", place.alias("place"))
    number = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A few numbers for each shuffle partition: values that occur, so each range ends with a row.
    ends = rows.agg(F.percentile_approx("place", [i / number for i in range(1, number)]).alias("p"), F.max("place").alias("m")).first()
    bounds = np.array(sorted({*(ends.p or []), *([] if ends.m is None else [ends.m])}), dtype=np.int64)

    @pandas_udf("array<int>")
    def codes(at: pd.Series) -> pd.Series:
        block = np.searchsorted(bounds, at.to_numpy())
        last = bounds[block] == at.to_numpy()
        return pd.Series([[2 * b, 2 * ((b + 1) % len(bounds)) + 1] if x else [2 * b] for b, x in zip(block.tolist(), last, strict=True)])

    none = F.lit(None).cast("long")
    rows = rows.select(F.explode(codes("place")).alias("code"), "doc_id", "place", "_key", "text", F.lit(1).alias("kind"), none.alias("n_shingles"), none.alias("component_id"))
    if near is not None:  # rows of one handle have one component, which stands before them
        each = near.groupBy("doc_id", "_key").agg(F.first("n_shingles").alias("n_shingles"), F.first("component_id").alias("component_id")).withColumn("place", place)
        rows = rows.unionByName(each.select(F.get(codes("place"), F.lit(0)).alias("code"), "doc_id", "place", "_key", F.lit(None).cast("string").alias("text"), F.lit(0).alias("kind"), "n_shingles", "component_id"))
    rows = rows.withColumn("block", F.expr("code div 2"))
    rows = rows.repartition("block").sortWithinPartitions("block", "code", F.desc("place"), F.desc("_key"), "doc_id", "kind")
    # After a range's own rows (even code) comes its guest (odd code); only the first guest counts.
    found = rows.select("code", "doc_id", "_key", "text", "kind", "n_shingles", "component_id").mapInArrow(_pairs, _EDITED + _LINKED)
    return found if near is not None else found.drop("n_shingles", "component_id")


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = T.documents(spark, sf_dir)
    return edited_fingerprints(docs, near_duplicates(docs))

"""Exact dedup against immutable snapshots, screened by static binary-fuse filters.

A snapshot is a set of documents that no longer changes. Its digests are cut into buckets of
about KEYS_PER_BUCKET, and each bucket gets one 8-bit binary-fuse filter (three places in
neighbouring segments per key, built by peeling). An incoming batch is first grouped by
digest on its own, so a group of copies of any size is one row from there on. Then each of
its digests is screened by its bucket's filter: a negative is new for certain; a positive is
joined with the exact bucket, and the bytes of one text of either side are compared.

The digest is SHA-256 of the text, null as empty, with A-Z lower-cased. Of equal texts the
largest doc_id stays. Rows that repeat both doc_id and text share one verdict; a null
doc_id stays only where no text of its group has a doc_id. Should two texts share a digest
and differ, the batch's group stays apart from the snapshot's.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

KEYS_PER_BUCKET = 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _places(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three places of each key, in neighbouring segments, and its fingerprint."""
    h = T.mix(keys + T.U(seed))
    g = T.mix(h + T.U(0x9E3779B97F4A7C15))
    low = np.int64(length - 1)
    first = ((h >> T.U(32)) * T.U(segments) >> T.U(32)).astype(np.int64) * length
    inside = [(x & T.U(0x3FFFF)).astype(np.int64) & low for x in (h, g, g >> T.U(20))]
    return np.stack([first + k * length + x for k, x in enumerate(inside)]), (g >> T.U(56)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> bytes:
    """Binary-fuse filter of distinct 64-bit keys: 16 bytes of header, then fingerprints."""
    n = len(keys)
    length = min(1 << 18, 1 << max(2, math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / length) - 2)
    for seed in range(1, 1000):
        if seed % 20 == 0:
            segments += 1 + segments // 20
        places, prints = _places(keys, seed, length, segments)
        size = (segments + 2) * length
        count = np.bincount(places.ravel(), minlength=size)
        held = np.zeros(size, dtype=np.int64)
        for row in places:
            np.bitwise_xor.at(held, row, np.arange(n))
        rounds, todo, peeled = [], np.flatnonzero(count == 1), 0
        while len(todo):
            key, at = np.unique(held[todo], return_index=True)
            rounds.append((key, todo[at]))
            peeled += len(key)
            touched = places[:, key]
            for row in touched:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(held, row, key)
            touched = np.unique(touched)
            todo = touched[count[touched] == 1]
        if peeled == n:
            table = np.zeros(size, dtype=np.uint8)
            for key, place in reversed(rounds):
                table[place] = 0
                table[place] = prints[key] ^ np.bitwise_xor.reduce(table[places[:, key]], axis=0)
            return np.array([seed, length, segments, n], dtype="<u4").tobytes() + table.tobytes()
    raise ValueError("keys must be distinct")


def maybe_in(filter_bytes: bytes, keys: np.ndarray) -> np.ndarray:
    """False only for keys that the filter was not built from."""
    seed, length, segments, n = (int(x) for x in np.frombuffer(filter_bytes, dtype="<u4", count=4))
    if not n:
        return np.zeros(len(keys), dtype=bool)
    places, prints = _places(keys, seed, length, segments)
    return np.bitwise_xor.reduce(np.frombuffer(filter_bytes, dtype=np.uint8, offset=16)[places], axis=0) == prints


def _keys(digests: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in digests.to_pylist()), dtype="<u8").copy()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [hashlib.sha256((x.as_py() or "").encode("utf-8", "surrogatepass").lower()).digest() for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "_id", "_key", "old")] + [pa.array(out, pa.binary())], names=["doc_id", "_id", "_key", "old", "digest"])


def digests(docs: DataFrame, old) -> DataFrame:
    """doc_id, handle, old (boolean: in the snapshot) and digest of each row."""
    rows = T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), "text", old.alias("old"))
    return rows.mapInArrow(_digest, "doc_id long, _id long, _key long, old boolean, digest binary")


def snapshot_filters(snapshot: DataFrame) -> DataFrame:
    """bucket, filter: one binary-fuse filter for each bucket of a frame of distinct digests with `bucket`."""

    def task(key, table):
        return pa.table({"bucket": [key[0].as_py()], "filter": pa.array([build_filter(np.unique(_keys(table.column("digest"))))], pa.binary())})

    return snapshot.select("bucket", "digest").groupBy("bucket").applyInArrow(task, "bucket long, filter binary")


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests of a batch (distinct, with `bucket`) that the snapshot may hold."""

    def task(left, right):
        if not left.num_rows or not right.num_rows:
            return left.select(["digest"]).slice(0, 0)
        return left.select(["digest"]).filter(pa.array(maybe_in(right.column("filter")[0].as_py(), _keys(left.column("digest")))))

    return batch.select("bucket", "digest").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(task, "digest binary")


def dedup(docs: DataFrame, old) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, in_snapshot.

    `old` is a boolean column: true for rows of the immutable snapshot, else incoming.
    """
    buckets = max(1, math.ceil(docs.count() / KEYS_PER_BUCKET))
    rows = digests(docs, F.coalesce(old, F.lit(False)))
    groups = rows.groupBy("old", "digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"), F.min(F.struct("_id", "_key")).alias("sample"))
    groups = groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    kept, new = groups.where("old"), groups.where("not old")
    maybe = screen(new, snapshot_filters(kept))
    both = maybe.join(new.select("digest", F.col("keep_id").alias("keep_b"), F.col("n").alias("n_b"), F.col("sample").alias("b")), "digest").join(
        kept.select("digest", F.col("keep_id").alias("keep_a"), F.col("n").alias("n_a"), F.col("sample").alias("a")), "digest"
    )
    needed = both.select("digest", F.explode(F.array("a", "b")).alias("at")).select("digest", "at._id", "at._key")
    plain = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    texts = T.handled(docs, "text").join(needed, ["_id", "_key"]).select("digest", plain.alias("plain"))
    equal = texts.groupBy("digest").agg((F.min("plain") == F.max("plain")).alias("same")).where("same").select("digest")
    same = both.join(equal, "digest").select("digest", F.greatest("keep_a", "keep_b").alias("keep_ab"), (F.col("n_a") + F.col("n_b")).alias("n_ab"))
    final = groups.join(same, "digest", "left").select("old", "digest", F.coalesce("keep_ab", "keep_id").alias("keep_id"), F.coalesce("n_ab", "n").alias("group_size"))
    # Written before the join, whose hot digests Spark then splits.
    return rows.select("doc_id", "old", "digest").join(materialize(final, "groups"), ["old", "digest"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), F.col("old").alias("in_snapshot"))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """The snapshot is the half of the documents with an odd crc32 of doc_id; the others come in."""
    docs = T.documents(spark, sf_dir)
    return dedup(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1).drop("in_snapshot")


ORACLE = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
  doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
from d
"""

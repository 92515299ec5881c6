"""Substring dedup by seed and extend.

A window is `length` consecutive words of one document; a window whose word sequence also
starts anywhere else (same document included) is repeated. Every window elects one anchor:
the k-gram of least hash among its `length - k + 1` k-grams (winnowing), so equal windows
elect equal anchors. Consecutive windows with one anchor are a run.

1. Seed: count the runs of each anchor; join the runs with the anchors that occur again.
2. Extend: if all runs of an anchor have the same words, each of them matches another one
   to both ends. Otherwise runs with equal words are grouped, and one run of each group is
   extended word by word to both sides: each of its windows is compared by 128 bits, of two independent hashes of each
   word; so are the words of runs.
   No pair of a group is ever built, so work is linear in the size of a group.
3. Keep: overlapping repeated windows form the maximal repeats, which are cut out.

Anchors are shuffled as partial counts; the joins are plain equi-joins whose hot keys Spark
splits (adaptive skew join). Texts are shuffled once, by document.

Null or empty text has no words. Null doc_id is a document like others. Rows repeated as a
whole repeat each other's words. Documents under `length` words keep everything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

LENGTH = 35
ANCHOR = 8
#: Words handled at once; positions in a block take PLACE bits of the anchor order.
WORD_BLOCK = 1 << 20
PLACE = 22
_RUN = "anchor long, seg long, seg2 long, _id long, _key long, run long"
_WINDOW = "w1 long, w2 long, _id long, _key long, start long"
_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, repeats array<struct<start:long,end:long>>"


def _elected(hashes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor position for each window of one sequence of words, and the k-gram hashes."""
    grams = np.zeros(len(hashes) - k + 1, dtype=T.U)
    for j in range(k):
        grams = grams * T.U(0x9FB21C651E98DF25) + hashes[j : len(hashes) - k + 1 + j]
    grams = T.mix(grams)
    low = T.U((1 << PLACE) - 1)
    least, width, span = (grams & ~low) | np.arange(len(grams), dtype=T.U), length - k + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return (least & low).astype(np.int64), grams


def _runs(length: int, k: int):
    """Rows of _RUN for each run of windows; run is its first word * 64 + its number of windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.buffers(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy() for c in ("_id", "_key"))
            for a, b in T.blocks(offsets):
                _, _, hashes, others, first = T.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                parts = []
                if len(hashes) <= WORD_BLOCK:
                    parts.append((hashes, others, 0))
                else:  # one long document, in blocks that share length - 1 words
                    parts += [(hashes[p : p + WORD_BLOCK + length - 1], others[p : p + WORD_BLOCK + length - 1], p) for p in range(0, len(hashes) - length + 1, WORD_BLOCK)]
                for part, other, base in parts:
                    if len(part) < length:
                        continue
                    place, grams = _elected(part, length, k)
                    row = np.searchsorted(first, np.arange(len(part)) + base, "right") - 1
                    own = row[: len(place)] == row[length - 1 :]
                    head = own.copy()
                    head[1:] &= (place[1:] != place[:-1]) | ~own[:-1] | (row[1 : len(place)] != row[: len(place) - 1])
                    start = np.flatnonzero(head)
                    if not len(start):
                        continue
                    ends = np.flatnonzero(own & np.append(head[1:] | ~own[1:], True)) + 1
                    count = ends - start
                    offset = (place[start] - start).astype(T.U) + T.U(1)
                    seg = T.ranges(part, start, ends + length - 1, T.WORDS_1) ^ T.mix(offset)
                    seg2 = T.ranges(other, start, ends + length - 1, T.WORDS_2) ^ T.mix2(offset)
                    at = row[start]
                    yield pa.RecordBatch.from_arrays([pa.array(T.signed(grams[place[start]])), pa.array(T.signed(seg)), pa.array(T.signed(seg2)), pa.array(ids[a:b][at]), pa.array(keys[a:b][at]), pa.array((start + base - first[at]) * 64 + count)], names=["anchor", "seg", "seg2", "_id", "_key", "run"])

    return task


def _windows(length: int):
    """Rows of _WINDOW for the windows of the runs in `runs`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.buffers(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy() for c in ("_id", "_key"))
            lists = batch.column("runs")
            runs, cut = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            cut = cut - cut[0]
            for a, b in T.blocks(offsets):
                _, _, hashes, others, first = T.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                own = runs[cut[a] : cut[b]]
                row = np.repeat(np.arange(b - a), np.diff(cut[a : b + 1]))
                count = own & 63
                at = np.repeat(row, count)
                start = np.repeat(own >> 6, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                begin = first[at] + start
                w1, w2 = (T.ranges(h, begin, begin + length, p) for h, p in ((hashes, T.WORDS_1), (others, T.WORDS_2)))
                for p in range(0, len(at), T.BLOCK):
                    q = slice(p, p + T.BLOCK)
                    yield pa.RecordBatch.from_arrays([pa.array(T.signed(w1[q])), pa.array(T.signed(w2[q])), pa.array(ids[a:b][at[q]]), pa.array(keys[a:b][at[q]]), pa.array(start[q])], names=["w1", "w2", "_id", "_key", "start"])

    return task


def _cut(length: int, with_text: bool):
    """Rows of _KEPT: each document without the words under its runs of repeated windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "repeats"]
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in names[1:]}
            sizes, begin = 0, 0

            def out(end: int) -> pa.RecordBatch:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                return pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, end - begin), *(pa.array(rows[n], kind) for n, kind in zip(names[1:], kinds, strict=True))], names=names)  # noqa: B023

            for i, (text, runs) in enumerate(zip(batch.column("text"), batch.column("spans"), strict=True)):
                cut = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n, repeats = len(cut), []
                if runs.is_valid:
                    own = np.sort(runs.values.to_numpy())
                    start, stop = own >> 6, (own >> 6) + (own & 63) + length - 1
                    stop = np.maximum.accumulate(stop)
                    heads = np.flatnonzero(np.append(True, start[1:] > stop[:-1]))
                    repeats = [(int(s), int(e)) for s, e in zip(start[heads], stop[np.append(heads[1:] - 1, len(stop) - 1)], strict=True)]
                    kept, last = [], 0
                    for s, e in repeats:
                        kept += cut[last:s]
                        last = e
                    cut = kept + cut[last:]
                whole = b" ".join(cut)
                rows["n_words"].append(n)
                rows["n_removed"].append(n - len(cut))
                rows["kept_sha256"].append(hashlib.sha256(whole).hexdigest())
                rows["kept_text"].append(whole.decode("utf-8", "surrogatepass") if with_text else None)
                rows["repeats"].append([{"start": s, "end": e} for s, e in repeats])
                sizes += len(whole)
                if sizes > 8 * T.BLOCK:
                    yield out(i + 1)
                    rows, sizes, begin = {n: [] for n in names[1:]}, 0, i + 1
            if begin < batch.num_rows:
                yield out(batch.num_rows)

    return task


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text, repeats (word spans).

    `length` is at most 63 + anchor, so that a run's number of windows fits its six bits.
    """
    if not anchor <= length <= 62 + anchor:
        raise ValueError("length must be from anchor to anchor + 62 words")
    texts = T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = texts.select("text", "_id", "_key").mapInArrow(_runs(length, anchor), _RUN)
    seeds = runs.groupBy("anchor").agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in ("seg", "seg2") for f, n in ((F.min, "low"), (F.max, "high"))])
    # Written before the join: Spark splits hot keys only where a join reads plain shuffles on both sides.
    seeds = materialize(seeds.where("n > 1").select("anchor", F.expr("low_seg <> high_seg or low_seg2 <> high_seg2").alias("mixed")), "seeds")
    # Written once: the branches below need different columns, and would each shuffle all runs again.
    found = materialize(runs.join(seeds, "anchor"), "runs")
    mixed = found.where("mixed")
    alike = mixed.groupBy("anchor", "seg", "seg2").agg(F.count("*").alias("n"), F.min(F.struct("_id", "_key", "run")).alias("first"))
    mixed = mixed.join(materialize(alike, "alike"), ["anchor", "seg", "seg2"])
    full = found.where("not mixed").unionByName(mixed.where("n > 1"), allowMissingColumns=True).select("_id", "_key", "run")
    probes = mixed.where("n = 1 or first = struct(_id, _key, run)").groupBy("_id", "_key").agg(F.collect_set("run").alias("runs"))
    windows = texts.join(probes, ["_id", "_key"]).mapInArrow(_windows(length), _WINDOW)
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hits = windows.join(again, ["w1", "w2"]).select("_id", "_key", (F.col("start") * 64 + 1).alias("run"))
    spans = full.unionByName(hits).groupBy("_id", "_key").agg(F.collect_set("run").alias("spans"))
    return texts.join(spans, ["_id", "_key"], "left").select("doc_id", "text", "spans").mapInArrow(_cut(length, with_text), _KEPT)


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    cut = remove_repeats(T.documents(spark, sf_dir), with_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("repeats").cast("long").alias("n_repeats"))


ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
w as (select rid, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i, len(ws) as n from d),
h as (select rid, i, n, word, md5(string_agg(word, ' ') over (partition by rid order by i rows between current row and {LENGTH - 1} following)) as h from w),
r as (select rid, i, word, i + {LENGTH - 1} <= n and count(*) filter (i + {LENGTH - 1} <= n) over (partition by h) > 1 as again from h),
c as (select rid, i, word, again, bool_or(again) over (partition by rid order by i rows between {LENGTH - 1} preceding and current row) as gone from r),
b as (select *, gone and not coalesce(lag(gone) over (partition by rid order by i), false) as head from c),
k as (select rid, string_agg(word, ' ' order by i) filter (not gone) as kept, count(*) filter (gone) as n_removed, count(*) filter (head) as n_repeats from b group by rid)
select doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256, coalesce(n_repeats, 0) as n_repeats from d left join k using (rid)
"""

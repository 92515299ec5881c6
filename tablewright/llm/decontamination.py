"""Benchmark decontamination as a prefix-filtered set join.

A window is WINDOW consecutive words of an item, or a whole item of fewer words. Its set is
its shingles of K words (of all its words if it has fewer). A document contains a window if
the window's words occur there in sequence.

1. Tasks read each document once. A bitmap of the items' shingles (`screen`) marks the places
   that can belong to a window; by the length filter a run of marked places counts only if it
   is as long as the least window. What is left are segments: a document's words that overlap
   no other segment of it. Each task also counts the marked shingles of all documents.
2. Equal segments are one row from here on, so copied passages cost one search.
3. Each window elects its rarest shingle by those counts. As containment has to be whole, the
   necessary prefix is that one token. A window with a shingle that no document has is out.
   Segments and windows join on it; the position of the shingle in both gives the window's
   place, which has to lie inside the segment.
4. The words at the place are compared with those of the window.

Words are runs of letters, digits and all characters beyond ASCII; A-Z are lower-cased. Null
or empty texts, also of items, have no words. Each row of docs gives a row, also if doc_id is
null or repeated. Items with one item_id count once; a null item_id marks words but is not
counted. Long texts are cut into segments in blocks of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import screen
from . import text as T

WINDOW = 10
K = 3
#: Words of one document that are screened at once.
WORD_BLOCK = 1 << 20
#: Marked shingles that a task counts before it reports.
COUNTED = 1 << 20


def equal_runs(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of one label other than 0."""
    padded = np.concatenate(([0], labels, [0]))
    at = np.flatnonzero(padded[1:] != padded[:-1])
    marked = padded[at[:-1] + 1] > 0
    return at[:-1][marked], at[1:][marked]


def item_words(texts: pa.Array) -> list[list[str]]:
    data, offsets = T.buffers(texts)
    start, end, first = T.runs(T.ALNUM[data], offsets)
    low = T.LOWER[data]
    words = [low[s:e].tobytes().decode("utf-8", "surrogatepass") for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    return [words[p:q] for p, q in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive words of one sequence of word hashes."""
    out = np.full(max(0, len(words) - size + 1), size, dtype=T.U)
    for j in range(size):
        out = T.mix(out * T.U(0x9FB21C651E98DF25) + words[j : j + len(out)])
    return out


def windows(items: DataFrame, length: int, k: int) -> DataFrame:
    """item_id, window (its words), size and grams (shingle hashes in order) of each distinct window of an item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column("item_id"), item_words(batch.column("text")), strict=True):
                size = min(length, len(words))
                raw = [w.encode("utf-8", "surrogatepass") for w in words]
                ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
                flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
                hashes, _ = T.identities(flat, np.concatenate(([0], ends[:-1])).astype(np.int64), ends)
                grams = T.signed(gram_hashes(hashes, min(k, max(size, 1))))
                number = len(words) - size + 1 if words else 0
                for p in range(0, number, 4096):
                    at = range(p, min(number, p + 4096))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(at), pa.int64()), pa.array([" ".join(words[i : i + size]) for i in at], pa.string()), pa.array([size] * len(at), pa.int64()), pa.array([grams[i : i + size - min(k, size) + 1] for i in at], pa.list_(pa.int64()))],
                        names=["item_id", "window", "size", "grams"],
                    )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(task, "item_id long, window string, size long, grams array<long>").distinct()


def segment_places(low: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, marks: screen.Screen, kinds: list[tuple[int, int]], seen: list[np.ndarray]) -> list[list[tuple[int, int]]]:
    """First word and end of the segments of each row; the marked shingles go to `seen`."""
    found: list[list[tuple[int, int]]] = [[] for _ in first[1:]]
    widest = max(k + least - 1 for k, least in kinds)
    # Blocks of a long text share the words of a window, so that each window lies in one of them.
    for q in range(0, len(start), WORD_BLOCK):
        part = slice(q, min(len(start), q + WORD_BLOCK + widest - 1))
        hashes, _ = T.identities(low, start[part], end[part])
        row = np.searchsorted(first, np.arange(part.start, part.stop), "right")
        cover = np.zeros(len(hashes) + 1, dtype=np.int64)
        for k, least in kinds:
            grams = gram_hashes(hashes, k)
            hit = marks.test(grams) & (row[: len(grams)] == row[k - 1 :])
            seen.append(grams[:WORD_BLOCK][hit[:WORD_BLOCK]])
            begin, stop = equal_runs(hit * row[: len(grams)])
            long = stop - begin >= least
            np.add.at(cover, begin[long], 1)
            np.add.at(cover, stop[long] + k - 1, -1)
        for s, e in zip(*(x.tolist() for x in equal_runs((np.cumsum(cover)[:-1] > 0) * row)), strict=True):
            own = found[row[s] - 1]
            if own and q + s <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], q + e))
            else:
                own.append((q + s, q + e))
    return found


def _segments(marks, kinds: list[tuple[int, int]]):
    """Rows of doc_id, rid, n_words, segments; and of gram, n for counted shingles."""
    names = ["doc_id", "rid", "n_words", "segments", "gram", "n"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        seen: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            gram, n = np.unique(np.concatenate(seen), return_counts=True)
            none = pa.nulls(len(gram), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.nulls(len(gram), pa.list_(pa.string())), pa.array(T.signed(gram)), pa.array(n)], names=names)

        for whole in batches:
            for p in range(0, whole.num_rows, 1024):
                batch = whole.slice(p, 1024)
                data, offsets = T.buffers(batch.column("text"))
                n_words, segments = [], []
                for a, b in T.blocks(offsets):
                    low = T.LOWER[data[offsets[a] : offsets[b]]]
                    start, end, first = T.runs(T.ALNUM[low], offsets[a : b + 1] - offsets[a])
                    n_words += np.diff(first).tolist()
                    places = segment_places(low, start, end, first, marks.value, kinds, seen) if kinds else [[]] * (b - a)
                    segments += [[" ".join(low[start[w] : end[w]].tobytes().decode("utf-8", "surrogatepass") for w in range(*span)) for span in own] for own in places]
                none = pa.nulls(batch.num_rows, pa.int64())
                ids = pa.array(np.arange(rid, rid + batch.num_rows))
                rid += batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(n_words, pa.int64()), pa.array(segments, pa.list_(pa.string())), none, none], names=names)
                if sum(map(len, seen)) > COUNTED:
                    yield counted()
                    seen = []
        if seen:
            yield counted()

    return task


def _posted(kinds: list[tuple[int, int]]):
    """Rows of sid, gram, at_word, n for each shingle of a segment of n words."""
    names = ["sid", "gram", "at_word", "n"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, words in zip(batch.column("sid").to_pylist(), batch.column("words"), strict=True):
                data = np.frombuffer(words.as_py().encode("utf-8", "surrogatepass"), dtype=np.uint8)
                start, end, _ = T.runs(~T.SPACE[data], np.array([0, len(data)]))
                hashes, _ = T.identities(data, start, end)
                for k, _ in kinds:
                    grams = T.signed(gram_hashes(hashes, k))
                    for p in range(0, len(grams), WORD_BLOCK):
                        part = grams[p : p + WORD_BLOCK]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), sid)), pa.array(part), pa.array(np.arange(p, p + len(part))), pa.array(np.full(len(part), len(start)))], names=names)

    return task


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sid, place, size, window for the candidates whose words stand in the segment."""
    names, kinds = ["sid", "place", "size", "window"], (pa.int64(), pa.int64(), pa.int64(), pa.string())
    for batch in batches:
        out: list[tuple] = []
        for sid, text, found in zip(*(batch.column(c).to_pylist() for c in ("sid", "words", "found")), strict=True):
            words = text.split(" ")
            out += [(sid, c["place"], c["size"], c["window"]) for c in found if words[c["place"] : c["place"] + c["size"]] == c["window"].split(" ")]
        columns = zip(*out, strict=True) if out else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names=names)


def occurrences(segments: DataFrame, counts: DataFrame, wins: DataFrame, kinds: list[tuple[int, int]]) -> DataFrame:
    """sid, place, size, window: every place of a window in the segments (sid, words).

    `counts` has how often each shingle (gram, n) stands in all documents.
    """
    grams = wins.select("window", "size", F.posexplode("grams").alias("at", "gram"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at")).alias("p")
    prefix = grams.join(counts, "gram", "left").groupBy("window", "size").agg(rarest).where("p.n > 0")
    prefix = materialize(prefix.select("window", "size", "p.gram", "p.at"), "prefixes")
    posted = segments.mapInArrow(_posted(kinds), "sid long, gram long, at_word long, n long")
    place = F.col("at_word") - F.col("at")
    fits = posted.join(prefix, "gram").where((place >= 0) & (place + F.col("size") <= F.col("n")))
    found = fits.groupBy("sid").agg(F.collect_set(F.struct(place.alias("place"), "size", "window")).alias("found"))
    return segments.join(found, "sid").mapInArrow(_verify, "sid long, place long, size long, window string")


def decontaminate(docs: DataFrame, items: DataFrame, length: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids (as sorted strings)."""
    if not 1 <= k <= length:
        raise ValueError("k must be from 1 to length words")
    spark = docs.sparkSession
    owned = materialize(windows(items, length, k), "windows")
    wins = materialize(owned.select("window", "size", "grams").distinct(), "windows")
    shape = wins.groupBy((F.col("size") - F.size("grams") + 1).alias("k")).agg(F.min(F.size("grams")).alias("least"))
    kinds = sorted((r.k, r.least) for r in shape.collect())
    marks = spark.sparkContext.broadcast(screen.build(wins.select(F.explode("grams").alias("h")).distinct()))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = read.mapInArrow(_segments(marks, kinds), "doc_id long, rid long, n_words long, segments array<string>, gram long, n long")
    read = materialize(read, "segments")
    rows = read.where("rid is not null").select("doc_id", "rid", "n_words")
    held = read.where("size(segments) > 0").select("rid", F.explode("segments").alias("words"))
    counts = read.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
    # Equal segments are searched once.
    segments = materialize(held.select("words").distinct().select(F.monotonically_increasing_id().alias("sid"), "words"), "segments")
    found = materialize(occurrences(segments, counts, wins, kinds), "found")
    spans = F.array_sort(F.collect_set(F.struct("place", (F.col("place") + F.col("size")).alias("end"))))
    add = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["place"], acc["last"]))).alias("n"), F.greatest(acc["last"], x["end"]).alias("last"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("last"))
    hits = found.groupBy("sid").agg(F.aggregate(spans, zero, add)["n"].alias("n_hit"))
    whose = found.select("sid", "window").distinct().join(owned.select("window", "item_id"), "window")
    whose = whose.groupBy("sid").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    searched = materialize(segments.join(hits, "sid").join(whose, "sid").select("words", "n_hit", "items"), "searched")
    hit = held.join(searched, "words").groupBy("rid").agg(F.sum("n_hit").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    out = rows.join(hit, "rid", "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def op13_decontamination(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as ws from documents),
b as (select item_id, {_WORDS} as ws from benchmark),
z as (select item_id, ws, least({WINDOW}, len(ws)) as size from b where len(ws) > 0),
v as (select distinct item_id, size, ws[p : p + size - 1] as win from (select item_id, ws, size, unnest(range(1, len(ws) - size + 2)) as p from z)),
s as (select distinct size from v),
g as (select rid, p, size, ws[p : p + size - 1] as win from (select rid, ws, size, unnest(range(1, len(ws) - size + 2)) as p from d, s where len(ws) >= size)),
o as (select rid, p, size, item_id from g join v using (size, win)),
h as (select rid, count(distinct w) as n_hit from (select rid, unnest(range(p, p + size)) as w from (select distinct rid, p, size from o)) group by 1),
i as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct rid, item_id::varchar as item from o where item_id is not null) group by 1)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (rid) left join i using (rid)
"""

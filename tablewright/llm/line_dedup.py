"""Line dedup by an exact set-similarity join.

Lines are cut at newlines. A line's set is its distinct words. A line is removed if an
earlier line (by doc_id, then by place in the document) has a Jaccard similarity of at least
`percent`; the earliest line of each kind stays, and so do lines without words.

1. Lines with equal sets are one class, at the place of its earliest line; the others go.
2. The words of a class are ordered by rarity: by the number of times they occur, then by
   a hash. The numbers come from a sketch over all texts: CELLS one-byte counters, exact up
   to 16 and in steps of nine percent beyond, which words may share, so a number may be too high
   but never too low. Any order gives the same result. Two sets alike enough share a word
   among the first |x| - ceil(t |x|) + 1 of each, so classes meet by these prefix words if a
   word occurs in more than one prefix; words that occur once cannot. Classes of so few
   words that only equal sets are alike (under 9 at 90 percent) need not meet.
3. In a word, classes are compared with all earlier ones, but in words of more than MANY with
   the first one only; there, a class that is not alike after all is compared with the
   others in a second turn. So large groups of variants need about one comparison a class.
   Pairs are not compared where their sizes, their words after the shared one (positions) or
   64-bit maps of their words rule the threshold out. A bit is the parity of the words that
   fall on it, so words that two lines share cancel out: at most as many bits differ as words do.

Texts are shuffled once, where lines are removed. The lines to compare are found by a second
scan by their places, screened by a sketch of these (lines let through by chance are not used).

A null text stays null. A null doc_id sorts as -1. Rows repeated as a whole keep and lose the
same lines. Sets are known by 128 bits, of two independent hashes of each word; words of one
pair of lines are told apart by 64 mixed bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import materialize, release
from . import text as T
from .linking import verified

PERCENT = 90
#: Counters of a sketch, one byte each; broadcast.
CELLS = 1 << 24
SKETCH_BLOCKS = 64
#: Classes of one word that are compared with each other at once.
MANY = 64
#: The number that each value of a counter stands for.
HELD = np.concatenate([np.arange(16.0), 2 ** (4 + np.arange(240) / 8)])
#: The counter of the numbers of two counters together, at 256 times the one plus the other.
BOTH = np.minimum(np.searchsorted(HELD, HELD[:, None] + HELD), 255).astype(np.uint8).ravel()


def line_sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: row and place (line number) of each line with words, the sorted distinct word
    hashes of all its lines, their number per line, and the identities of the sets."""
    data, offsets = T.buffers(texts)
    for a, b in T.blocks(offsets):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        start, _, hashes, others, _ = T.words(part, at)
        breaks = np.flatnonzero(part == 10)
        text = np.searchsorted(at, start, "right") - 1
        before = np.searchsorted(breaks, start)  # newlines of the block before the word
        head = np.append(True, (before[1:] != before[:-1]) | (text[1:] != text[:-1])) if len(start) else np.zeros(0, dtype=bool)
        heads = np.flatnonzero(head)
        own = text[heads]
        line = before[heads] - np.searchsorted(breaks, at[own])
        yield a + own, line, *T.distinct(hashes, others, np.cumsum(head) - 1, len(heads))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> T.U(64 - CELLS.bit_length() + 1)).astype(np.int64)


def _add(total: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Counters plus numbers, rounded up to what a counter can hold."""
    return np.minimum(np.searchsorted(HELD, HELD[total] + more), 255).astype(np.uint8)


def _united(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Counters of the numbers of two sketches together."""
    return BOTH.take(one.astype(np.uint16) << 8 | other)


def _sketched(hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]]):
    """block, cells: the sketch of the hashes that a task sees, compressed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, dtype=np.uint8)
        for batch in batches:
            for some in hashes(batch):
                cells = np.sort(_cell(some).astype(np.uint32))
                heads = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else np.zeros(0, dtype=np.int64)
                total[cells[heads]] = _add(total[cells[heads]], np.diff(np.append(heads, len(cells))))
        if total.any():
            parts = total.reshape(SKETCH_BLOCKS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=["block", "cells"])

    return task


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of rows sorted by block."""
    block, total = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["block", "cells"])
    for batch in batches:
        for b, cells in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
            part = np.frombuffer(zlib.decompress(cells.as_buffer()), dtype=np.uint8)
            if b != block and block is not None:
                yield out()
            block, total = b, part if b != block else _united(total, part)
    if block is not None:
        yield out()


def sketch(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray:
    """CELLS counters of the hashes in rows, on the driver: CELLS bytes whatever the rows."""
    parts = rows.mapInArrow(_sketched(hashes), "block int, cells binary")
    for spread in (F.expr("pmod(hash(cells), 16)"), F.lit(0)):  # the parts of many tasks never meet in one
        parts = parts.withColumn("_s", spread).repartition("block", "_s").sortWithinPartitions("block", "_s").drop("_s").mapInArrow(_merged, "block int, cells binary")
    total = np.zeros((SKETCH_BLOCKS, CELLS // SKETCH_BLOCKS), dtype=np.uint8)
    for row in parts.collect():
        total[row.block] = _united(total[row.block], np.frombuffer(zlib.decompress(row.cells), dtype=np.uint8))
    return total.ravel()


def _words(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, offsets = T.buffers(batch.column("text"))
    for a, b in T.blocks(offsets):
        part = data[offsets[a] : offsets[b]]
        start, end, _ = T.runs(T.solid(part), offsets[a : b + 1] - offsets[a])
        yield T.identities(part, start, end, both=False)[0]


def _places(ids: np.ndarray, keys: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A hash of the handle and the place of lines."""
    return T.mix(T.mix(T.mix(ids.astype(np.int64).view(T.U)) ^ keys.astype(np.int64).view(T.U)) + lines.astype(T.U))


def _wanted(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield _places(*(batch.column(c).to_numpy() for c in ("_id", "_key", "line")))


def _lines(shared, percent: int):
    """node, handle, place, size and map of each line, and the prefix words of its set.

    A word that occurs once is null; sets that can only be like an equal one have no words.
    """
    names = ["node", "_id", "_key", "line", "size", "map", "words"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("_id", "_key"))
            for row, line, flat, sizes, node in line_sets(batch.column("text")):
                if not len(row):
                    continue
                begin = np.cumsum(sizes) - sizes
                many = counts[_cell(flat)]
                bits = np.bitwise_xor.reduceat(T.U(1) << ((flat >> T.U(20)) & T.U(63)), begin)
                rank = (many.astype(T.U) << T.U(54)) | (flat >> T.U(10))
                # The first words of each line by rank: as many as its prefix has.
                length = np.where((sizes + 1) * percent <= sizes * 100, sizes - (sizes * percent + 99) // 100 + 1, 0)
                sort = T.ordered(rank, np.repeat(np.arange(len(row)), sizes), len(row))
                at = sort[np.arange(len(flat)) - np.repeat(begin, sizes) < np.repeat(length, sizes)]
                cut = np.concatenate(([0], np.cumsum(length)))
                words = pa.array(T.signed(flat[at]), mask=many[at] <= 1)
                yield pa.RecordBatch.from_arrays([T.binary(node), pa.array(ids[row]), pa.array(keys[row]), pa.array(line), pa.array(sizes.astype(np.int32)), pa.array(T.signed(bits)), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words)], names=names)

    return task


def _fit(size, place, bits, i, j, percent: int) -> np.ndarray:
    """Whether the rows i and j of one word can be alike."""
    n, m = size[i], size[j]
    most = np.minimum(n - place[i], m - place[j]) + np.minimum(place[i], place[j])
    need = ((n + m) * percent + 99 + percent) // (100 + percent)  # least number of common words
    apart = np.bitwise_count(bits[i] ^ bits[j])
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent) & (most >= need) & (apart <= n + m - 2 * need)


def _pairs(percent: int, order: tuple[str, ...] = ()):
    """a, b, first: pairs of classes to compare, from rows sorted by word; in large words by the columns `order`.

    `first` is true where b was compared with the first class of a large word only.
    """

    def paired(rows: dict[str, np.ndarray], node: pa.Array) -> pa.RecordBatch:
        word = rows["word"]
        size, place, bits = rows["size"].astype(np.int64), rows["place"].astype(np.int64), rows["map"].view(T.U)
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, dtype=np.int64)
        length = np.diff(np.append(heads, len(word)))
        behind = np.arange(len(word)) - np.repeat(heads, length)
        large = np.repeat(length > MANY, length)
        if order and large.any():
            some = np.flatnonzero(large)
            to = np.arange(len(word))
            to[some] = some[np.lexsort([*(rows[c][some] for c in reversed(order)), word[some]])]
            size, place, bits, node = size[to], place[to], bits[to], node.take(pa.array(to))
        lead = np.repeat(heads, length)
        i = np.flatnonzero(large & (behind > 0))
        met = i[_fit(size, place, bits, i, lead[i], percent)]
        found = [(lead[met], met, np.ones(len(met), dtype=bool))]
        open_ = np.ones(len(word), dtype=bool)
        open_[met] = False
        step, rest = 1, np.flatnonzero(behind >= 1)
        rest = rest[open_[rest]]
        while len(rest):
            hit = rest[_fit(size, place, bits, rest, rest - step, percent)]
            found.append((hit - step, hit, np.zeros(len(hit), dtype=bool)))
            step += 1
            rest = rest[behind[rest] >= step]
        a, b, first = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b)), pa.array(first)], names=["a", "b", "first"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        nodes: list[pa.Array] = []
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in ("word", "size", "place", "map", *order)}
            last = rows["word"][-1] if batch.num_rows else None
            if last is None:
                continue
            cut = int(np.flatnonzero(np.append(True, rows["word"][1:] != rows["word"][:-1]))[-1])
            if cut or (held and held[-1]["word"][-1] != last):  # a word ends in this batch
                held.append({c: v[:cut] for c, v in rows.items()})
                nodes.append(batch.column("node").slice(0, cut))
                yield paired({c: np.concatenate([h[c] for h in held]) for c in rows}, pa.concat_arrays(nodes))
                held, nodes = [], []
            held.append({c: v[cut:] for c, v in rows.items()})
            nodes.append(batch.column("node").slice(cut))
        if held:
            yield paired({c: np.concatenate([h[c] for h in held]) for c in held[0]}, pa.concat_arrays(nodes))

    return task


def _screened(shared):
    """One row for each prefix word that the sketch may hold, from rows of classes."""
    names = ["node", "size", "map"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            flat, length = words.flatten(), np.diff(words.offsets.to_numpy())
            word = flat.fill_null(0).to_numpy()
            use = np.flatnonzero((shared.value[_cell(word.view(T.U))] > 0) & flat.is_valid().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(length)), length)[use]
            place = use - (np.cumsum(length) - length)[row]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in names), pa.array(place.astype(np.int32)), pa.array(word[use])], names=[*names, "place", "word"])

    return task


def _word_column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column("word").to_numpy().view(T.U)


def _texts(shared):
    """Handle, place and text of the lines whose places the sketch may hold; no word is looked at."""
    names = ["_id", "_key", "line", "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in names[:2])
            data, offsets = T.buffers(batch.column("text"))
            for a, b in T.blocks(offsets):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                breaks = np.flatnonzero(part == 10)
                row = np.concatenate((np.arange(b - a), np.searchsorted(at, breaks, "right") - 1))
                start = np.concatenate((at[:-1], breaks + 1))
                order = np.lexsort((start, row))
                row, start = row[order], start[order]
                end = np.append(start[1:] - 1, len(part))
                last = np.append(row[1:] != row[:-1], True)
                end[last] = at[1:][row[last]]
                line = np.arange(len(row)) - np.searchsorted(row, row)
                use = np.flatnonzero(wanted[_cell(_places(ids[a + row], keys[a + row], line))] > 0)
                texts = [part[i:j].tobytes().decode() for i, j in zip(start[use].tolist(), end[use].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a + row[use]]), pa.array(keys[a + row[use]]), pa.array(line[use]), pa.array(texts, pa.string())], names=names)

    return task


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row as it is, text without the lines with words that are not in `kept`, n_lines, n_removed, kept_sha256."""
    for batch in batches:
        out: dict[str, list] = {"text": [], "n_lines": [], "n_removed": [], "kept_sha256": []}
        for text, kept in zip(batch.column("text").to_pylist(), batch.column("kept").to_pylist(), strict=True):
            lines = text.split("\n") if text is not None else []
            keep = set(kept or ())
            rest = [x for i, x in enumerate(lines) if i in keep or not x.encode("utf-8", "surrogatepass").split()]
            new = None if text is None else "\n".join(rest)
            out["text"].append(new)
            out["n_lines"].append(len(lines))
            out["n_removed"].append(len(lines) - len(rest))
            out["kept_sha256"].append(hashlib.sha256((new or "").encode("utf-8", "surrogatepass")).hexdigest())
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], names=["row", *out])


def kept_lines(docs: DataFrame, percent: int) -> DataFrame:
    """Handle and `kept`, the places of the lines with words that stay."""
    context = docs.sparkSession.sparkContext
    counts = context.broadcast(sketch(docs.select("text"), _words))
    lines = T.handled(docs, "text").mapInArrow(_lines(counts, percent), "node binary, _id long, _key long, line long, size int, map long, words array<long>")
    classes = lines.groupBy("node").agg(F.min(F.struct("_id", "_key", "line", "size", "map", "words")).alias("c"))
    classes = materialize(classes.select("node", F.struct("c._id", "c._key", "c.line").alias("at"), "c.size", "c.map", "c.words"), "classes")
    counts.destroy()
    posted = classes.select(F.posexplode("words").alias("place", "word"), "node", F.col("at._id").alias("id"), F.col("at._key").alias("key"), F.col("at.line").alias("line"), "size", "map").where("word is not null")
    # In large words, the order in which lines are removed: a class meets the first that stands before it.
    # Spark sorts by the word alone, which needs no comparison of rows.
    pairs = posted.repartition("word").sortWithinPartitions("word").mapInArrow(_pairs(percent, ("id", "key", "line")), "a binary, b binary, first boolean")
    # Another word of a pair says nothing of the rest of its large word: one mark is enough.
    pairs = pairs.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b"), "late": F.col("first") & (F.col("a") < F.col("b")), "early": F.col("first") & (F.col("a") > F.col("b"))})
    pairs = materialize(pairs.groupBy("a", "b").agg(F.max("late").alias("late"), F.max("early").alias("early")), "pairs")
    places = classes.select("node", "at")

    def removed(pairs: DataFrame) -> DataFrame:
        """The later one of each pair that is alike."""
        ends = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(places, "node"), "ends")
        screen = context.broadcast(sketch(ends.select("at.*"), _wanted))
        # The lines are cut out by their places, so that their words need not be hashed again.
        texts = T.handled(docs, "text").mapInArrow(_texts(screen), "_id long, _key long, line long, text string")
        texts = texts.join(ends.select("node", "at.*"), ["_id", "_key", "line"])
        texts = materialize(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")
        screen.destroy()
        found = verified(pairs.select("a", "b"), texts, 1, False, percent).where("linked")
        found = found.join(ends.withColumnsRenamed({"node": "a", "at": "at_a"}), "a").join(ends.withColumnsRenamed({"node": "b", "at": "at_b"}), "b")
        release(docs.sparkSession)
        return materialize(found.select(F.when(F.col("at_a") < F.col("at_b"), F.col("b")).otherwise(F.col("a")).alias("node")).distinct(), "removed")

    gone = removed(pairs)
    # Classes that were compared with the first of a large word only, and are not removed.
    left = pairs.where("late").select(F.col("b").alias("node")).union(pairs.where("early").select("a"))
    left = materialize(left.distinct().join(gone, "node", "left_anti"), "left")
    if not left.isEmpty():
        # Classes are joined or screened before their words become rows.
        sets = classes.select("node", "size", "map", "words")
        own = sets.join(left, "node").select("node", "size", "map", F.posexplode("words").alias("place", "word")).where("word is not null")
        own = materialize(own, "left")
        screen = context.broadcast(sketch(own.select("word"), _word_column))
        other = sets.mapInArrow(_screened(screen), "node binary, size int, map long, place int, word long")
        other = other.withColumnsRenamed({"node": "other", "size": "m", "map": "other_map", "place": "other_place"})
        met = own.join(other, "word").where("node <> other")
        most = F.least(F.col("size") - F.col("place"), F.col("m") - F.col("other_place")) + F.least("place", "other_place")
        need = F.ceil((F.col("size") + F.col("m")) * percent / (100 + percent))
        apart = F.bit_count(F.col("map").bitwiseXOR(F.col("other_map")))
        met = met.where((F.least("size", "m") * 100 >= F.greatest("size", "m") * percent) & (most >= need) & (apart <= F.col("size") + F.col("m") - 2 * need))
        more = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        more = materialize(more, "pairs")
        screen.destroy()
        gone = gone.union(removed(more)).distinct()
    return classes.join(gone, "node", "left_anti").groupBy("at._id", "at._key").agg(F.collect_list("at.line").alias("kept"))


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """row (the other columns of docs), text without the repeated lines, n_lines, n_removed, kept_sha256."""
    rows = T.handled(docs, "text", T.boxed(docs, but="text"))
    kept = kept_lines(docs, percent)
    rows = rows.join(kept, ["_id", "_key"], "left").drop("_id", "_key")
    schema = StructType([rows.schema["row"], StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])
    return rows.select("row", "text", "kept").mapInArrow(_without, schema)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    rows = without_repeated_lines(T.documents(spark, sf_dir))
    return rows.select("row.doc_id", "n_lines", "n_removed", "kept_sha256")


ORACLE = f"""
with d as (select doc_id, string_split(text, chr(10)) as ls from documents),
u as (select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as i from d),
l as (select row_number() over (order by doc_id, i) as lid, *, list_distinct(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as ws from u),
t as (select lid, len(ws) as n, unnest(ws) as word from l),
f as (select word, count(*) as c from t group by 1),
k as (select lid, n, word, row_number() over (partition by lid order by c, word) as k from t join f using (word)),
p as (select lid, n, word from k where k <= n - ({PERCENT} * n + 99) // 100 + 1),
c as (select distinct a.lid as a, b.lid as b, a.n as na, b.n as nb from p a join p b using (word) where a.lid < b.lid and least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {PERCENT}),
x as (select c.a, c.b, any_value(na + nb) as n, count(*) as common from c join t ta on ta.lid = c.a join t tb on tb.lid = c.b and tb.word = ta.word group by c.a, c.b),
g as (select distinct b as lid from x where 100 * common >= {PERCENT} * (n - common)),
e as (select doc_id, count(*) as n_lines, count(g.lid) as n_removed, string_agg(line, chr(10) order by i) filter (g.lid is null) as kept from l left join g using (lid) group by doc_id)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join e using (doc_id)
"""

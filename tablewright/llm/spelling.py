"""Spelling variants by dynamic programming over sorted word lists.

1. Tasks cut the texts into words and count them; the counts of all tasks are added up.
2. Two words of m and m or m + 1 code points with one edit share their first m // 2 code points,
   or the last m // 2 ones (the edit lies on one side). So each word is in a group for each such
   beginning and end, and near words meet in exactly one group that may report them.
3. A group is a sorted list. It is scanned once for all words of the group: the rows of the edit
   matrix, three cells wide, are kept for each code point of the current word, and the next word
   goes on from the row of its common prefix. Words whose rows exceed one edit leave the scan at
   that code point; where all have left, the list is skipped to the first word with another
   prefix. Large groups are cut into PART words; each part is scanned for each part.
4. Each word takes its near word of largest count; forms are followed to the last by doubling.

A run is a maximal sequence of letters A-Z, a-z and U+00C0-U+00FF, A-Z lower-cased. Where the
crc32 of `<doc_id>:<run>` is a multiple of MISPRINT, the run loses a code point. Null or empty
texts have no runs; rows with a null doc_id keep all their runs as they are. Repeated rows count
as often as they stand there. Long texts are read in blocks; words may have any length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import text as T

SIZE, COUNT, RATIO, MISPRINT = 6, 5, 5, 199
#: Words of a group that one task holds twice: as a list and as those searched in it.
PART = 8192
#: Bytes of words that a task collects before it counts them.
COUNTED = 1 << 24

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


CRC = _crc_table()


def crc32(begun: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] after the texts whose crc32 is `begun`, for many spans at once."""
    state = begun ^ np.uint32(0xFFFFFFFF)
    live, at = np.arange(len(start)), start
    while len(live):
        more = at < end[live]
        live, at = live[more], at[more]
        now = state[live]
        state[live] = CRC[(now ^ data[at]) & np.uint32(255)] ^ (now >> np.uint32(8))
        at = at + 1
    return state ^ np.uint32(0xFFFFFFFF)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of runs as start and end, and first run of each row."""
    solid = LETTER[data]
    # U+00C0-U+00FF are the byte C3 and one that follows it.
    lead = data == 0xC3
    solid |= lead
    solid[1:] |= lead[:-1]
    return T.runs(solid, offsets)


def misprinted(doc_id: pa.Array, first: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs that lose a code point, and the hashes that say so."""
    ids = doc_id.to_pylist()
    heads = np.array([zlib.crc32(f"{x}:".encode()) for x in ids], dtype=np.uint32)
    known = np.repeat(np.array([x is not None for x in ids], dtype=bool), np.diff(first))
    h = crc32(np.repeat(heads, np.diff(first)), low, start, end)
    at = np.flatnonzero((h % np.uint32(every) == 0) & known)
    return at, h[at]


def _counts(size: int, every: int):
    """Rows of word, n: words of at least `size` code points by task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def counted() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.large_string()))
            return pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

        total = 0
        for batch in batches:
            data, offsets = T.buffers(batch.column("text"))
            for a, b in T.blocks(offsets):
                low = T.LOWER[data[offsets[a] : offsets[b]]]
                start, end, first = runs(low, offsets[a : b + 1] - offsets[a])
                points = np.concatenate(([0], np.cumsum((low & 0xC0) != 0x80)))
                long = points[end] - points[start] >= size
                first = np.concatenate(([0], np.cumsum(long)))[first]
                start, end = start[long], end[long]
                if not len(start):
                    continue
                at, hashes = misprinted(batch.column("doc_id").slice(a, b - a), first, low, start, end, every)
                shorter = []
                for s, e, h in zip(start[at].tolist(), end[at].tolist(), hashes.tolist(), strict=True):
                    word = low[s:e].tobytes().decode()
                    if len(word) > size:
                        cut = h % len(word)
                        shorter.append(word[:cut] + word[cut + 1 :])
                whole = np.ones(len(start), dtype=bool)
                whole[at] = False
                start, end = start[whole], end[whole]
                inside = np.zeros(len(low) + 1, dtype=np.int8)
                inside[start] = 1
                np.add.at(inside, end, -1)
                flat = low[np.cumsum(inside, dtype=np.int8)[:-1] > 0]
                cut = np.concatenate(([0], np.cumsum(end - start)))
                held += [pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(flat)), pa.array(shorter, pa.large_string())]
                total += len(flat)
                if total > COUNTED:
                    yield counted()
                    held, total = [], 0
        if held:
            yield counted()

    return task


def vocabulary(docs: DataFrame, size: int = SIZE, count: int = COUNT, every: int = MISPRINT) -> DataFrame:
    """word, n: the words of at least `size` code points that occur at least `count` times."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_counts(size, every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


class Words:
    """Words as one array of code points (all below 256), three zeros after each."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.array([len(w) for w in words], dtype=np.int64)
        self.begin = np.cumsum(self.size + 3) - self.size - 3
        self.flat = np.frombuffer(b"\0\0\0".join([*words, b""]), dtype=np.uint8)


def scan(words: list[bytes], asked: list[bytes], shared: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each place of the sorted list `words`, the places in `asked` of words one edit away.

    All words begin with the same `shared` code points.
    """
    q = Words(asked)
    # Rows by code point: words still in the scan, and the cells left of, on and right of the diagonal.
    everyone = np.arange(len(asked))
    one, none = np.ones(len(asked), dtype=np.int8), np.zeros(len(asked), dtype=np.int8)
    stack = [(everyone, one, none, one)]
    commons = [shared, *(len(os.path.commonprefix((x, y))) for x, y in zip(words, words[1:], strict=False)), shared]
    for k, word in enumerate(words):
        depth = min(commons[k], shared + len(stack) - 1)
        del stack[depth - shared + 1 :]
        if not len(stack[-1][0]):
            continue  # all have left at a prefix that this word has, too
        while depth < len(word):
            who, left, mid, right = stack[-1]
            if len(who) == 1 and commons[k + 1] <= depth and asked[who[0]] == word:
                break  # the rest of this word is nobody else's, and only itself is left
            at = q.begin[who] + depth
            c = word[depth]
            new_left = np.minimum(mid + 1, left + (q.flat[at - 1] != c))
            new_mid = np.minimum(np.minimum(right + 1, mid + (q.flat[at] != c)), new_left + 1)
            new_right = np.minimum(right + (q.flat[at + 1] != c), new_mid + 1)
            depth += 1
            stay = (np.minimum(np.minimum(new_left, new_mid), new_right) <= 1) & (q.size[who] >= depth - 1)
            stack.append((who[stay], new_left[stay], new_mid[stay], new_right[stay]))
            if not stay.any():
                break
        else:
            who, left, mid, right = stack[-1]
            off = q.size[who] - len(word)
            cell = np.where(off == 0, mid, np.where(off == 1, right, left))
            found = who[(cell == 1) & (np.abs(off) <= 1)]
            if len(found):
                yield k, found


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of word, near, near_n for each part of a group (rows sorted by group and part)."""
    names, kinds = ["word", "near", "near_n"], (pa.string(), pa.string(), pa.int64())
    keys = ["side", "half", "shared", "asked_part", "list_part"]
    held: dict[str, list] = {}
    now = None

    def out() -> Iterator[pa.RecordBatch]:
        if now is None or len(held["word"]) < 2:
            return
        side, half, flip = now[0], now[1], slice(None, None, -1 if now[0] else 1)
        rows = sorted(zip((w.encode("latin-1")[flip] for w in held["word"]), held["word"], held["n"], held["role"], strict=True))
        listed, asked = [r for r in rows if r[3] != 0], [r for r in rows if r[3] != 1]
        got: list[tuple] = []
        for k, found in scan([r[0] for r in listed], [r[0] for r in asked], half):
            _, word, n, _ = listed[k]
            for j in found.tolist():
                other = asked[j][1]
                # Each pair is reported by the group of its shorter word's half, at the end only if beginnings differ.
                if min(len(word), len(other)) // 2 == half and not (side and word[:half] == other[:half]):
                    got.append((other, word, n))
            if len(got) > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*got, strict=True), kinds, strict=True)], names=names)
                got = []
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*got, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*keys, "word", "n", "role")]
        for *key, word, n, role in zip(*columns, strict=True):
            if key != now:
                yield from out()
                now, held = key, {"word": [], "n": [], "role": []}
            held["word"].append(word)
            held["n"].append(n)
            held["role"].append(role)
    yield from out()


def near_words(words: DataFrame) -> DataFrame:
    """word, near, near_n: all words one edit away, for each word of `words` (word, n)."""
    size = F.length("word")
    half = F.explode(F.array_distinct(F.array((size / 2).cast("int"), ((size - 1) / 2).cast("int")))).alias("half")
    halves = words.select("word", "n", half)
    ends = F.array(F.struct(F.lit(0).alias("side"), F.expr("left(word, half)").alias("shared")), F.struct(F.lit(1).alias("side"), F.expr("right(word, half)").alias("shared")))
    keyed = halves.select("word", "n", "half", F.explode(ends).alias("end")).select("word", "n", "half", "end.*")
    keys = ["side", "half", "shared"]
    sizes = keyed.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
    sizes = materialize(sizes.select(*keys, F.ceil(F.col("size") / PART).cast("int").alias("parts")), "groups")
    keyed = keyed.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # Role 2: listed and asked; 0: asked only; 1: listed only.
    other = "filter(sequence(0, parts - 1), x -> x <> part)"
    copies = F.expr(f"concat(array(struct(part as asked_part, part as list_part, 2 as role)), transform({other}, x -> struct(part as asked_part, x as list_part, 0 as role)), transform({other}, x -> struct(x as asked_part, part as list_part, 1 as role)))")
    rows = keyed.select(*keys, "word", "n", F.explode(copies).alias("c")).select(*keys, "c.*", "word", "n")
    order = [*keys, "asked_part", "list_part"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(_near, "word string, near string, near_n long")


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root: the last form that each word (word, form) leads to; counts rise, so forms end."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = materialize(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, size: int = SIZE, count: int = COUNT, ratio: int = RATIO, every: int = MISPRINT) -> DataFrame:
    """word, n, form, root, n_near, form_n of each word of the vocabulary."""
    words = materialize(vocabulary(docs, size, count, every), "vocabulary")
    near = near_words(words)
    # Of equal counts the smallest word: least of (-count, word).
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.less")).alias("most"), "best.near")
    takes = F.col("most") >= F.col("n") * ratio
    found = materialize(found.select("word", "n", "n_near", F.when(takes, F.col("near")).alias("form"), F.when(takes, F.col("most")).alias("form_n")), "forms")
    roots = last_forms(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(T.documents(spark, sf_dir))


ORACLE = f"""
with recursive k as (select i, list_reduce(list_prepend(i, range(8)), lambda c, x: case when c & 1 = 1 then xor(c >> 1, {_POLYNOMIAL}) else c >> 1 end) as v from range(256) t(i)),
t as (select list(v order by i) as crc from k),
r as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents),
c as (select doc_id, run, count(*) as n from r where len(run) >= {SIZE} group by all),
b as (select doc_id, run, n, flatten(list_transform(string_split(doc_id::varchar || ':' || run, ''), lambda x: case when ord(x) < 128 then [ord(x)] else [195, ord(x) - 64] end)) as bytes from c),
h as (select run, n, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda s, x: xor(crc[(xor(s, x) & 255) + 1], s >> 8)), 4294967295) as h from b, t),
w as (select case when h % {MISPRINT} = 0 then left(run, (h % len(run))::int) || substr(run, (h % len(run))::int + 2) else run end as word, n from h),
v as (select word, sum(n)::bigint as n from w where len(word) >= {SIZE} group by 1 having sum(n) >= {COUNT}),
e as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, len(word) + 1)) as i from v)),
p as (select a.word, b.word as near, b.n as near_n from e a join e b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select e.word, v.word, v.n from e join v on e.rest = v.word union select v.word, e.word, e.n from e join v on e.rest = v.word),
q as (select word, count(*) as n_near, max(near_n) as most from p group by 1),
m as (select p.word, min(near) as near from p join q on p.word = q.word and near_n = most group by 1),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= {RATIO} * v.n then near end as form, case when most >= {RATIO} * v.n then most end as form_n from v left join q using (word) left join m using (word)),
o as (select word, word as root from f where form is null union all select f.word, o.root from f join o on f.form = o.word)
select word, form, root, n, n_near, form_n from f join o using (word)
"""

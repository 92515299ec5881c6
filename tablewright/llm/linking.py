"""Links between texts whose shingle sets are alike, and the components they form.

Used by operators that name candidate keys for a text so that any two texts to be linked
share a key. Texts with equal sets are one node, so copies cost one row each.

1. Sort the keys with the nodes that have them, by size, one of PARTS parts of the keys after
   another; a node that fits no neighbour in size is done in this key, as are keys of one node.
2. Nodes of keys of more than LARGE nodes are verified against one pivot, that of their
   largest key, so a dense group of copies costs one comparison a node and not one a key.
   Then, in rounds, each key with nodes of more than one component elects a pivot, and the other
   components' nodes are verified against it. Links found join components, so a dense group
   of near copies closes after pivots instead of all its pairs. Keys of two nodes are done
   after the first round.
3. Keys that are still open after the rounds: nodes outside a key's largest component are
   compared with the rest of the key, in blocks of at most BLOCK of both inside a task. Only
   pairs that the sizes, the triangle inequality of the Jaccard distance (to the first pivot)
   and the parity maps let through may become rows, and are verified. Of these, a node leads
   FEW in a key, those of the closest maps. Their links join components, and keys in which a
   node had more go into another turn, in which it leads MORE times as many of those that are
   still in another component. The turns end when no node had more, so no link is lost; links
   inside a component never become rows, nor do pairs that cannot be links. Two nodes that
   share many keys meet where their keys before the shared one differ, not at each.

Before texts are fetched, a pair must pass the parity maps of its sets: MAP bits, each the
parity of the shingles that fall on it; large sets have a wider map as well, of two bits a
shingle or more. At most as many bits differ as shingles do, so no link is lost. Only the texts of nodes of such pairs are fetched, screened by a sketch of their
handles (what it lets through by chance is not used).

Pairs meet by pivot, and the nodes of a pivot are spread over as many tasks as they need.
A node is known by 128 bits: two independent hashes of words, of shingles made of them, and of
the set. Within a verified pair, shingles are told apart by 64 mixed bits.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.recursion import components
from ..session import drop, materialize, recorded, release
from . import screen
from . import text as T

ROUNDS = 2
#: Nodes compared with one copy of a pivot.
PER_PIVOT = 256
#: Nodes of a key from which its nodes first meet one pivot only.
LARGE = 8
#: Parts of the keys whose postings are shuffled one after another, so that a part's files stand at a time.
PARTS = 4
#: Bits of a set's parity map.
MAP = 1024
#: Nodes of a key on each side of a block that a task compares in the last round.
BLOCK = 2048
#: Pairs that a task compares at once.
AT_ONCE = 1 << 16
#: Pairs that a node leads in a key of the last round, and times as many in each further turn.
FEW, MORE = 2, 16

Keys = Callable[[pa.Array, list[np.ndarray]], tuple[np.ndarray, np.ndarray]]
#: Whether each token of sets (flat, sizes) is in its set's prefix, under each further order.
Marks = Callable[[np.ndarray, np.ndarray], list[np.ndarray]]


def shingle_sets(texts: pa.Array, k: int, lower: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct shingle hashes of each text, and the identities of the sets."""
    data, offsets = T.buffers(texts)
    out, nodes = [], [np.zeros((0, 2), dtype=T.U)]
    for a, b in T.blocks(offsets):
        _, _, one, two, first = T.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], lower)
        grams, begin = T.shingles(one, first, k)
        other = T.shingles(two, first, k)[0] if k > 1 else two
        flat, sizes, node = T.distinct(grams, other, np.repeat(np.arange(b - a), np.diff(begin)), b - a)
        out += np.split(flat, np.cumsum(sizes)[:-1])
        nodes.append(node)
    return out, np.concatenate(nodes)


def parities(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The parity maps of sets (flat, sizes)."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    odd = np.bincount(row * MAP + (flat >> T.U(20) & T.U(MAP - 1)).astype(np.int64), minlength=len(sizes) * MAP) & 1
    return pa.array([x.tobytes() for x in np.packbits(odd.astype(np.uint8).reshape(-1, MAP), axis=1)], pa.binary())


def wide_parities(sets: list[np.ndarray]) -> pa.Array:
    """Parity maps of two bits or more a shingle, a power of two in all; null where MAP bits are as many.

    A map's blocks of half its size make the map of that size together, one XOR the other.
    """
    out: list[bytes | None] = []
    for s in sets:
        size = 1 << (2 * len(s) - 1).bit_length() if len(s) else 0
        at = (s >> T.U(20) & T.U(size - 1)).astype(np.int64) if size > MAP else None
        out.append(None if at is None else np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8)).tobytes())
    return pa.array(out, pa.binary())


def nodes(docs: DataFrame, keys: Keys, k: int, lower: bool) -> DataFrame:
    """doc_id, handle, n_shingles, node (null without shingles), candidate keys and parity maps of each row.

    Of equal sets in one task only the first has its keys and map, so copies are few where keys meet.
    """
    names = ["doc_id", "_id", "_key", "n_shingles", "node", "keys", "map", "wide"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for whole in batches:
            for p in range(0, whole.num_rows, 1024):
                batch = whole.slice(p, 1024)
                sets, node = shingle_sets(batch.column("text"), k, lower)
                sizes = np.array([len(s) for s in sets])
                node = T.binary(node, sizes == 0)
                found, cut = keys(batch.column("text"), sets)
                new = np.array([n not in seen and not seen.add(n) for n in node.to_pylist()], dtype=bool)
                length = np.diff(cut)
                found, cut = found[np.repeat(new, length)], np.concatenate(([0], np.cumsum(length * new)))
                use = new & (sizes > 0)
                flat = np.concatenate([x for x, u in zip(sets, use, strict=True) if u] or [np.zeros(0, dtype=T.U)])
                held = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(T.signed(np.ascontiguousarray(found))))
                at = pa.array(np.cumsum(use) - 1, mask=~use)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), pa.array(sizes.astype(np.int64)), node, held, parities(flat, sizes[use]).take(at), wide_parities([x for x, u in zip(sets, use, strict=True) if u]).take(at)], names=names)

    rows = T.handled(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(task, "doc_id long, _id long, _key long, n_shingles long, node binary, keys array<long>, map binary, wide binary")


def _wanted(shared):
    """The rows whose handles the screen may hold, one of each handle in a batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.flatnonzero(shared.value.test(batch.column("h").to_numpy().view(T.U)))
            handles = np.stack([batch.column(c).to_numpy()[at] for c in ("_id", "_key")], axis=1)
            at = at[np.unique(handles, axis=0, return_index=True)[1]]
            yield batch.select(["_id", "_key", "text"]).take(pa.array(at))

    return task


def texts_of(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """node and text of the rows (node, _id, _key) of ends."""
    marks = docs.sparkSession.sparkContext.broadcast(screen.build(ends.select(F.xxhash64("_id", "_key").alias("h"))))
    rows = T.handled(docs, "text").withColumn("h", F.xxhash64("_id", "_key")).mapInArrow(_wanted(marks), "_id long, _key long, text string")
    # Grouped by the join's columns too, so that texts are shuffled once.
    texts = materialize(rows.join(ends, ["_id", "_key"]).groupBy("_id", "_key", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")
    marks.destroy()
    return texts


def _agreeing(lead: np.ndarray, flat: np.ndarray, sizes: np.ndarray, further: Marks) -> np.ndarray:
    """Whether each of the sets (flat, sizes) shares a prefix token with the set `lead` under every further order."""
    begin, use = np.cumsum(sizes) - sizes, np.ones(len(sizes), dtype=bool)
    for own, other in zip(further(lead, np.array([len(lead)])), further(flat, sizes), strict=True):
        first = lead[own]
        at = np.minimum(np.searchsorted(first, flat), len(first) - 1)
        use &= np.logical_or.reduceat(other & (first[at] == flat), begin)
    return use


def verified(pairs: DataFrame, texts: DataFrame, k: int, lower: bool, percent: int, further: Marks | None = None) -> DataFrame:
    """pairs (a, b) with `linked` and `distance` (Jaccard); those without a common prefix token under a further order are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, kept = None, np.zeros(0, dtype=T.U)
        for whole in batches:
            for p in range(0, whole.num_rows, 1024):
                batch = whole.slice(p, 1024)
                sets, _ = shingle_sets(batch.column("text"), k, lower)
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                heads = [i for i, x in enumerate(b) if x is None]
                # Runs of rows that belong to one pivot; each is compared with it as a whole.
                for i, j in zip([-1, *heads], [*heads, len(b)], strict=True):
                    if i >= 0:
                        lead, kept = a[i], sets[i]
                    own = [x for x in range(i + 1, j) if a[x] == lead]
                    if not own:
                        continue
                    flat, sizes = np.concatenate([sets[x] for x in own]), np.array([len(sets[x]) for x in own])
                    if further:
                        use = _agreeing(kept, flat, sizes, further)
                        if not use.any():
                            continue
                        own, flat, sizes = [x for x, u in zip(own, use, strict=True) if u], flat[np.repeat(use, sizes)], sizes[use]
                    begin = np.cumsum(sizes) - sizes
                    at = np.minimum(np.searchsorted(kept, flat), len(kept) - 1)
                    same = kept[at] == flat
                    both = np.add.reduceat(same.astype(np.int64), begin)
                    either = len(kept) + sizes - both
                    linked = 100 * both >= percent * either
                    yield pa.RecordBatch.from_arrays([pa.array([a[x] for x in own], pa.binary()), pa.array([b[x] for x in own], pa.binary()), pa.array(linked), pa.array(1 - both / either)], names=["a", "b", "linked", "distance"])

    spread = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_PIVOT).cast("int").alias("parts"))
    few = pairs.join(spread, "a").select(F.col("b").alias("node"), "a", F.pmod(F.hash("b"), "parts").alias("part"), "b")
    leads = spread.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("binary").alias("b"))
    # Texts meet both sides in one join.
    rows = leads.unionByName(few).join(texts, "node").repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return rows.select("a", "b", "text").mapInArrow(task, "a binary, b binary, linked boolean, distance double")


def _fitting(percent: int):
    """One row for each node of a key, from rows sorted by key, size and node.

    In order of size, a node that fits none of its two neighbours fits no other node of the key.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, node = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros((0, 2), dtype=T.U)
        before = np.zeros(0, dtype=bool)  # whether the last row, which waits for the next, fits the one before it
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate((key, batch.column("key").to_numpy()))
            n, node = np.concatenate((n, batch.column("n").to_numpy())), np.concatenate((node, T.halves(batch.column("node"))))
            new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]).any(axis=1))
            key, n, node = key[new], n[new], node[new]
            fits = (key[1:] == key[:-1]) & (n[:-1] * 100 >= n[1:] * percent)
            up = np.concatenate((before if len(before) else [False], fits))
            use = np.flatnonzero(up[:-1] | fits)
            yield pa.RecordBatch.from_arrays([pa.array(key[use]), pa.array(n[use]), T.binary(node[use])], names=["key", "n", "node"])
            key, n, node, before = key[-1:], n[-1:], node[-1:], up[-1:]
        if before.any():
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), T.binary(node)], names=["key", "n", "node"])

    return task


def _alike(n: Column | str, m: Column | str, percent: int) -> Column:
    n, m = F.col(n), F.col(m)
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _wide(column: pa.Array) -> np.ndarray:
    """Parity maps of a column without nulls as rows of 64-bit numbers."""
    fixed = column.cast(pa.binary(MAP // 8))
    n = MAP // 64
    return np.frombuffer(fixed.buffers()[1], dtype=T.U)[n * fixed.offset : n * (fixed.offset + len(fixed))].reshape(-1, n) if len(fixed) else np.zeros((0, n), dtype=T.U)


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Bits in which parity maps differ."""
    return np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)


def _near(apart: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether maps so far apart let sets of `both` tokens together be linked."""
    need = (both * percent + 99 + percent) // (100 + percent)  # least number of common shingles
    return apart <= both - 2 * need


def _folded(one: bytes, other: bytes) -> int:
    """Bits in which two maps differ, the larger one folded to the size of the other."""
    a, b = sorted((np.frombuffer(x, dtype=T.U) for x in (one, other)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum(dtype=np.int64))


def close(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parity maps do not rule a link out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                apart = np.array([_folded(*pair) for pair in zip(batch.column("map_a").to_pylist(), batch.column("map_b").to_pylist(), strict=True)])
                yield batch.select(["a", "b"]).filter(pa.array(_near(apart, both, percent)))

    for side in ("a", "b"):
        pairs = pairs.join(maps.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.coalesce("wide", "map").alias(f"map_{side}")), side)
    return pairs.select("a", "b", "n_a", "n_b", "map_a", "map_b").mapInArrow(task, "a binary, b binary")


def linked(docs: DataFrame, keys: Keys, k: int, percent: int, lower: bool = False, further: Marks | None = None, mapped: bool = True) -> DataFrame:
    """doc_id, handle, n_shingles, component_id (least doc_id of the component; own where unlinked) of each row.

    `mapped` pairs must pass the parity maps before their texts are fetched; with `further` orders a
    pair must share prefix tokens under each of them before its sets are intersected.
    """
    with recorded() as steps:
        found = materialize(_linked(docs, keys, k, percent, lower, further, mapped), "linked")
    drop(docs.sparkSession, steps[:-1])  # all but the result
    return found


def _linked(docs: DataFrame, keys: Keys, k: int, percent: int, lower: bool, further: Marks | None, mapped: bool) -> DataFrame:
    spark = docs.sparkSession
    with recorded() as read:  # what the next steps read, and nothing later
        rows = materialize(nodes(docs, keys, k, lower), "nodes")
        posted = rows.where("node is not null").select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
        parts = []
        for p in range(PARTS):
            # One shuffle and one sort; keys of one node are done.
            part = posted.where(F.pmod("key", F.lit(PARTS)) == p).repartition("key").sortWithinPartitions("key", "n", "node").select("key", "n", "node")
            parts.append(materialize(part.mapInArrow(_fitting(percent), "key long, n long, node binary"), "postings"))
        held = functools.reduce(DataFrame.unionByName, parts)
    shared = held.groupBy("key").agg(F.min(F.struct("node", "n")).alias("p"), F.count("*").alias("size"))
    held = materialize(held.join(shared.select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), "size"), "key"), "postings")
    met = held.select("node").distinct()
    maps = rows.where("map is not null").join(met, "node").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first(F.struct("map", "wide")).alias("m")).select("node", "n", "m.*")
    maps = materialize(maps, "maps")
    rows = materialize(rows.drop("keys", "map", "wide"), "handles")
    drop(spark, read)
    first = rows.join(met, "node").groupBy("node").agg(F.min(F.struct("_id", "_key")).alias("at")).select("node", "at._id", "at._key")
    first = materialize(first, "handles")

    tested, roots, read, most, more, turn = None, None, [], FEW, None, -2
    while True:
        turn += 1
        drop(spark, read)
        release(spark)
        with recorded() as read:
            if turn < 1:
                now = held.where("node <> pivot")
                if turn < 0:  # the pivot of each node's largest key
                    now = now.where(F.col("size") > LARGE).groupBy("node").agg(F.max_by(F.struct("pivot", "pivot_n", "n"), F.struct("size", "key")).alias("p")).select("node", "p.*")
                elif roots is not None:
                    far = roots.withColumnsRenamed({"node": "pivot", "root": "pivot_root"})
                    now = now.join(roots, "node", "left").join(far, "pivot", "left").where(F.coalesce("root", "node") != F.coalesce("pivot_root", "pivot"))
                pairs = now.withColumnsRenamed({"pivot": "lead", "pivot_n": "lead_n"})
            else:
                now = held.where("size > 2") if more is None else held.join(more, "key", "left_semi")
                now = now.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
                still = now.groupBy("key").agg(F.min("root").alias("l"), F.max("root").alias("h"), F.min_by(F.struct("node", "root", "n"), F.xxhash64("node", F.lit(turn))).alias("p")).where("l <> h")
                now = materialize(now.join(still.select("key", F.col("p.node").alias("lead"), F.col("p.root").alias("lead_root"), F.col("p.n").alias("lead_n")), "key"), "open")
                if now.isEmpty():
                    break
                pairs = now.where("root <> lead_root") if turn < ROUNDS else materialize(_rest(now, tested, maps, mapped, percent, most), "met")
            if turn < ROUNDS:
                pairs = pairs.where(_alike("n", "lead_n", percent))
            else:
                more = pairs.where("more").select("key").distinct()
            pairs = pairs.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()
            if tested is not None:
                pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
            if mapped:
                pairs = close(pairs, maps, percent)
            pairs = materialize(pairs, "pairs")
            some = turn == 0 or not pairs.isEmpty()
            if some:
                ends = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(first, "node"), "ends")
                texts = texts_of(docs, ends)
        last = turn >= ROUNDS and more.isEmpty()
        if turn >= ROUNDS and not last:
            more, most = materialize(more, "keys"), most * MORE
        if some:
            found = materialize(verified(pairs, texts, k, lower, percent, further), "tested")
            tested = found if tested is None else tested.unionByName(found)
            roots = components(tested.where("linked"))
        if last:
            break
    low = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    if roots is not None:
        low = low.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = low.groupBy("root").agg(F.min("low").alias("component_id"))
        low = low.join(least, "root").select("node", "component_id")
    else:
        low = low.withColumnRenamed("low", "component_id")
    return rows.join(low, "node", "left").select("doc_id", "_id", "_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _blocks(percent: int, mapped: bool, most: int):
    """key, lead, node: pairs of a block that nothing rules out, from rows sorted by key, block and n.

    Rows of role 1 lead, those of role 0 are met, those of role 2 do both. Each leads `most` pairs,
    of the closest maps; `more` is true where it could lead others.
    """

    def compared(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        n, node, root = rows["n"], rows["node"], rows["root"]
        new = np.append(True, (rows["key"][1:] != rows["key"][:-1]) | (rows["lead_part"][1:] != rows["lead_part"][:-1]) | (rows["part"][1:] != rows["part"][:-1]))
        cell = (np.cumsum(new) - 1) << 40
        leads, others = np.flatnonzero(rows["role"] > 0), np.flatnonzero(rows["role"] != 1)
        # The rows of the lead's block whose size fits.
        place = cell[others] + n[others]
        low = np.searchsorted(place, cell[leads] + (n[leads] * percent + 99) // 100)
        length = np.searchsorted(place, cell[leads] + n[leads] * 100 // percent, "right") - low
        end, found, p = np.cumsum(length), [], 0
        while p < len(leads):
            before = end[p] - length[p]
            q = max(p + 1, int(np.searchsorted(end, before + AT_ONCE, "right")))
            some = length[p:q]
            i = np.repeat(leads[p:q], some)
            j = others[np.arange(len(i)) - np.repeat(end[p:q] - some - before, some) + np.repeat(low[p:q], some)]
            p = q
            use = (root[i] != root[j]).any(axis=1)
            # Two outsiders meet in two blocks, or twice in one: it counts once.
            smaller = (node[j, 0] < node[i, 0]) | ((node[j, 0] == node[i, 0]) & (node[j, 1] < node[i, 1]))
            use &= ~rows["outer"][j] | smaller
            use &= ~(rows["again"][i] & rows["again"][j] & (rows["before"][i] == rows["before"][j]))
            use &= ~(np.abs(rows["distance"][i] - rows["distance"][j]) > (100 - percent) / 100 + 1e-9)
            i, j = i[use], j[use]
            both = n[i] + n[j]
            apart = _apart(rows["map"][i], rows["map"][j]) if mapped else np.abs(n[i] - n[j])
            if mapped:
                use = _near(apart, both, percent)
                i, j, apart, both = i[use], j[use], apart[use], both[use]
            order = np.lexsort((node[j, 0], apart / both, i))
            i, j = i[order], j[order]
            begin, behind = np.searchsorted(i, i), np.searchsorted(i, i, "right")
            use = np.arange(len(i)) - begin < most
            found.append((i[use], j[use], (behind - begin > most)[use]))
        i, j, more = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (leads, leads, leads > 0)
        return pa.RecordBatch.from_arrays([pa.array(rows["key"][i]), T.binary(node[i]), T.binary(node[j]), pa.array(more)], names=["key", "lead", "node", "more"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "lead_part", "part", "role", "outer", "n", "before", "again", "distance")}
            rows |= {"node": T.halves(batch.column("node")), "root": T.halves(batch.column("root")), "map": _wide(batch.column("map"))}
            held = {c: np.concatenate((held[c], v)) for c, v in rows.items()} if held else rows
            # The last block may go on in the next batch.
            last = [held[c] != held[c][-1] for c in ("key", "lead_part", "part")]
            cut = int(np.flatnonzero(np.append(True, last[0] | last[1] | last[2]))[-1])
            if cut:
                yield compared({c: v[:cut] for c, v in held.items()})
                held = {c: v[cut:] for c, v in held.items()}
        if held:
            yield compared(held)

    return task


def _rest(now: DataFrame, tested: DataFrame, maps: DataFrame, mapped: bool, percent: int, most: int) -> DataFrame:
    """Pairs (key, lead, node, more) of open keys that nothing rules out, `most` of a lead: outsiders against all other components of the key."""
    far = tested.select(F.explode(F.array(F.struct(F.col("a").alias("pivot"), F.col("b").alias("node"), "distance"), F.struct(F.col("b").alias("pivot"), F.col("a").alias("node"), "distance"))).alias("t")).select("t.*")
    now = now.join(far, ["pivot", "node"], "left").withColumn("distance", F.when(F.col("pivot") == F.col("node"), F.lit(0.0)).otherwise(F.col("distance")))
    # Two nodes that share the key before this one, too, meet there or earlier.
    before = F.lag("key").over(Window.partitionBy("node").orderBy("key"))
    now = materialize(now.select("key", "node", "root", "distance", before.alias("before")), "open")
    each = now.groupBy("key", "root").agg(F.count("*").alias("c"), F.count("before").alias("again"), F.min("before").alias("l"), F.max("before").alias("h"))
    sizes = each.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("all"), F.sum("again").alias("again"), F.min("l").alias("l"), F.max("h").alias("h"))
    sizes = sizes.where("not (again = all and l = h)")  # all of its nodes meet in the key before
    sizes = sizes.select("key", "main", F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("lead_parts"), F.ceil(F.col("all") / BLOCK).cast("int").alias("parts"))
    rows = now.join(sizes, "key").withColumn("outer", F.expr("root <> main"))
    part, lead_part = F.pmod(F.hash("node"), "parts"), F.pmod(F.hash("node"), "lead_parts")

    def place(lead: Column, met: Column, role: Column) -> Column:
        return F.struct(lead.cast("int").alias("lead_part"), met.cast("int").alias("part"), role.cast("int").alias("role"))

    # A node is met in its part by each part of leads; an outsider leads against each part.
    leading = F.when(F.col("outer"), F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: place(lead_part, p, F.lit(1)))).otherwise(F.array().cast("array<struct<lead_part:int,part:int,role:int>>"))
    places = F.concat(F.transform(F.sequence(F.lit(0), F.col("lead_parts") - 1), lambda p: place(p, part, F.lit(0))), leading)
    places = F.when(F.col("parts") == 1, F.array(place(F.lit(0), F.lit(0), F.when(F.col("outer"), 2).otherwise(0)))).otherwise(places)
    rows = rows.withColumn("p", F.explode(places)).select("key", "p.*", "outer", "node", "root", F.coalesce("before", F.lit(0)).alias("before"), F.col("before").isNotNull().alias("again"), F.coalesce("distance", F.lit(float("nan"))).alias("distance"))
    rows = rows.join(maps.drop("wide"), "node").repartition("key", "lead_part", "part").sortWithinPartitions("key", "lead_part", "part", "n")
    return rows.mapInArrow(_blocks(percent, mapped, most), "key long, lead binary, node binary, more boolean")

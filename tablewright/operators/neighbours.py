"""Nearest rows for many points at once, as a join of blocks.

1. PIVOTS rows, those of least key hash, are sent to all tasks. Every row and every point
   belongs to the cell of its nearest pivot; a cell is cut into blocks by the distance to it.
2. The triangle inequality gives the least distance that any point of one block can have
   from any row of another. Each block of points meets the HOME blocks of least such distance.
   That gives a radius: no point of the block has its k nearest rows beyond it.
3. The block of points meets all other blocks but those that begin beyond its radius.

A meeting is one matrix product, whose candidates are measured again in full, so results are
exact. A task holds one block of points and about PER_TASK blocks of rows, whatever the
number of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import materialize

PIVOTS = 64
BLOCK_ROWS = 1024
HOME = 4
PER_TASK = 16
#: Room for the rounding of distances to pivots, relative to the larger one.
SLACK = 1e-9


def _matrix(lists: pa.Array, rows: int) -> np.ndarray:
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _away(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _blocked(df: DataFrame, vector: str, key: str, pivots: np.ndarray, size: int) -> DataFrame:
    """block, cell, low and high (distances to the cell's pivot), near and far (least and greatest
    distances to every pivot), ids, vectors (one after the other)."""
    id_type, item = df.schema[key].dataType.simpleString(), df.schema[vector].dataType.elementType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _away(_matrix(batch.column("vector"), batch.num_rows), pivots)
                cell = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away.min(axis=1))], names=["id", "vector", "cell", "away"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else []
            for head, end in zip(heads, [*heads[1:], len(cell)], strict=True):
                for at in range(head, end, size):
                    part = batch.slice(at, min(size, end - at))
                    n, own = part.num_rows, part.column("away").to_numpy()
                    away = _away(_matrix(part.column("vector"), n), pivots)
                    lists = [pa.array([x], pa.list_(pa.float64())) for x in (away.min(axis=0), away.max(axis=0))]
                    for column in ("id", "vector"):
                        flat = part.column(column) if column == "id" else part.column(column).flatten()
                        lists.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
                    yield pa.RecordBatch.from_arrays([part.column("cell").slice(0, 1), pa.array([own[0]]), pa.array([own[-1]]), *lists], names=["cell", "low", "high", "near", "far", "ids", "vectors"])

    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    rows = rows.mapInArrow(placed, f"id {id_type}, vector array<{item}>, cell int, away double")
    # Rows of a large cell, and of one distance, are ranges of their own: no task holds more than its share.
    rows = rows.repartitionByRange("cell", "away", "id").sortWithinPartitions("cell", "away", "id")
    blocks = rows.mapInArrow(cut, f"cell int, low double, high double, near array<double>, far array<double>, ids array<{id_type}>, vectors array<{item}>")
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _measured(pairs: DataFrame, points: DataFrame, rows: DataFrame, k: int, key_types: tuple[str, str]) -> DataFrame:
    """The k best rows of each point in the blocks that its block meets, per group of blocks."""

    def best(asked: pa.Table, given: pa.Table) -> pa.Table:
        names = ["points", "query", "key", "distance"]
        ids = asked.column("asked").combine_chunks().flatten()
        p = _matrix(asked.column("at"), len(ids))
        p2 = (p * p).sum(axis=1)
        who, dist, what = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64)
        keys = given.column("ids").combine_chunks().flatten()
        order = np.argsort(keys.to_numpy(zero_copy_only=False), kind="stable")
        place = np.empty(len(order), dtype=np.int64)  # of a key among the keys of the group
        place[order] = np.arange(len(order))
        worst, begin = np.full(len(ids), np.inf), 0
        for one, lists in zip(given.column("ids"), given.column("vectors"), strict=True):
            n = len(one)
            x = lists.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            x2 = (x * x).sum(axis=1)
            about = p2[:, None] + x2 - 2 * (p @ x.T)
            most = np.partition(about, k - 1, axis=1)[:, k - 1] if n > k else np.full(len(ids), np.inf)
            room = 1e-9 * (p2 + x2.max() + 1)
            i, j = np.nonzero(about <= (np.minimum(most, worst**2) + room)[:, None])
            found = np.concatenate([np.sqrt(((x[j[a : a + 65536]] - p[i[a : a + 65536]]) ** 2).sum(axis=1)) for a in range(0, len(i), 65536)] or [np.zeros(0)])
            who, dist, what = np.concatenate([who, i]), np.concatenate([dist, found]), np.concatenate([what, place[begin + j]])
            sort = np.lexsort((what, dist, who))
            who, dist, what = who[sort], dist[sort], what[sort]
            rank = np.arange(len(who)) - np.searchsorted(who, who, "left")
            worst[who[rank == k - 1]] = dist[rank == k - 1]
            who, dist, what = who[rank < k], dist[rank < k], what[rank < k]
            begin += n
        block = np.full(len(who), asked.column("own")[0].as_py())
        return pa.Table.from_arrays([pa.array(block), ids.take(pa.array(who)), keys.take(pa.array(order[what])), pa.array(dist)], names=names)

    slots = pairs.groupBy("points").agg(F.ceil(F.count("*") / PER_TASK).alias("slots"))
    pairs = pairs.join(slots, "points").select("points", "block", F.pmod(F.xxhash64("block"), "slots").alias("slot"))
    pairs = materialize(pairs, "pairs")
    given = pairs.join(rows.select("block", "ids", "vectors"), "block").select("points", "slot", "ids", "vectors")
    asked = pairs.select("points", "slot").distinct().join(points.select(F.col("block").alias("points"), "ids", "vectors"), "points").select(F.col("points").alias("own"), F.col("slot").alias("part"), F.col("ids").alias("asked"), F.col("vectors").alias("at"))
    both = asked.groupBy("own", "part").cogroup(given.groupBy("points", "slot"))
    return both.applyInArrow(best, f"points bigint, query {key_types[0]}, key {key_types[1]}, distance double")


def meetings(points: DataFrame, rows: DataFrame) -> DataFrame:
    """points, block, gap (least possible distance) of every two blocks. Of blocks, not of rows."""
    cells = points.select(F.col("block").alias("points"), F.posexplode(F.arrays_zip("near", "far")).alias("cell", "to"))
    met = cells.join(rows.select("block", "cell", "low", "high"), "cell")
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("to.far"), F.col("to.near") - F.col("high"))
    return met.select("points", "block", (gap - SLACK * (F.col("high") + F.col("to.far"))).alias("gap"))


def nearest_each(df: DataFrame, vector: str, key: str, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS, report: dict | None = None) -> DataFrame:
    """query, rank, key, distance: the k rows of df nearest to each point of queries (`query`, `vector`).

    Ties go to the smaller key. Rows and points without a vector are left out; all vectors
    have one length. `report` takes the numbers of block pairs, in all and met.
    """
    types = queries.schema["query"].dataType.simpleString(), df.schema[key].dataType.simpleString()
    sample = df.where(F.col(vector).isNotNull()).select(F.xxhash64(key).alias("h"), F.col(vector).alias("v")).orderBy("h").limit(PIVOTS).collect()
    if not sample:
        return df.sparkSession.createDataFrame([], f"query {types[0]}, rank int, `{key}` {types[1]}, distance double")
    pivots = np.unique(np.array([r.v for r in sample], dtype=np.float64), axis=0)
    rows = _blocked(df, vector, key, pivots, block_rows)
    points = _blocked(queries, "vector", "query", pivots, block_rows)
    met = materialize(meetings(points, rows), "meetings")
    first = met.withColumn("n", F.row_number().over(Window.partitionBy("points").orderBy("gap", "block"))).where(F.col("n") <= HOME).drop("n")
    first = materialize(first, "home")
    found = materialize(_measured(first, points, rows, k, types), "found")
    # A point that has met fewer than k rows has no radius yet, and its block meets all others.
    kth = found.withColumn("n", F.row_number().over(Window.partitionBy("points", "query").orderBy("distance", "key"))).where(F.col("n") == k)
    sizes = points.select(F.col("block").alias("points"), F.size("ids").alias("size"))
    radius = kth.groupBy("points").agg(F.count("*").alias("known"), F.max("distance").alias("radius")).join(sizes, "points").where("known = size")
    rest = met.join(radius.select("points", "radius"), "points", "left").where("radius is null or gap <= radius")
    rest = materialize(rest.join(first.select("points", "block"), ["points", "block"], "left_anti").select("points", "block"), "rest")
    if report is not None:
        report |= {"pairs": met.count(), "met": first.count() + rest.count()}
    found = found.unionByName(_measured(rest, points, rows, k, types))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))).where(F.col("rank") <= k)
    return ranked.select("query", "rank", F.col("key").alias(key), "distance")

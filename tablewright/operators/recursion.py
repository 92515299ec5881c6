"""Recursive queries: level by level, or by doubling; each round is one distributed job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialize, scratch_path


def recurse(
    anchor: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    distinct: bool = True,
    identity: list[str] | None = None,
    max_depth: int | None = None,
) -> DataFrame:
    """WITH RECURSIVE: ``anchor UNION [ALL] step(last level)``, until a level is empty.

    With ``distinct`` a row that any earlier level had is dropped, so cycles
    end; ``identity`` names the columns that make a row the same (default all).
    Each level is written to the shared folder, so the plan of a level never
    contains the ones before it; of earlier levels only 16-byte hashes of the
    identity are read again. Only an emptiness test reaches the driver.
    """
    spark = anchor.sparkSession
    keys = identity or anchor.columns
    schema = anchor.schema
    root = scratch_path(spark, "levels")
    same = F.struct(F.xxhash64(*keys).alias("h1"), F.xxhash64(F.lit(1), *keys).alias("h2")).alias("_same")

    def write(df: DataFrame, level: int) -> DataFrame:
        path = f"{root}/level={level}"
        # Union types follow the anchor, and a level may not be narrower.
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        rows.select("*", same).write.parquet(path)
        return spark.read.parquet(path).select(*schema.names)

    def read_all(last: int) -> DataFrame:
        return spark.read.parquet(*[f"{root}/level={n}" for n in range(last + 1)])

    frontier = write(anchor.dropDuplicates(keys) if distinct else anchor, 0)
    level = 0
    while not frontier.isEmpty():
        if max_depth is not None and level >= max_depth:
            raise RecursionError(f"recursion passed {max_depth} levels")
        fresh = step(frontier).toDF(*anchor.columns)
        if distinct:
            seen = read_all(level).select("_same")
            fresh = fresh.dropDuplicates(keys).select("*", same).join(seen, "_same", "left_anti").drop("_same")
        level += 1
        frontier = write(fresh, level)
    return read_all(level).select(*schema.names)


def hierarchy(
    df: DataFrame,
    key: str,
    parent: str,
    carry: list[str] | None = None,
    separator: str = "->",
    path: str | None = "path",
    depth: str = "depth",
    root: str = "root",
) -> DataFrame:
    """Every row with its path to the root, its depth and its root key.

    By pointer doubling: each row knows the piece of its path up to some ancestor; a round
    joins it with that ancestor's piece, so pieces double and the rounds number the
    logarithm of the depth. Rows that have reached their root are not written again. The
    join is a plain one: a parent with very many children is split by Spark's skew join.

    Rows that reach no root (their parent is missing) are left out; a cycle is an error.
    ``path=None`` leaves out the paths, whose total length is the square of a chain's.
    """
    own = F.struct(F.col(parent).alias(parent), *(carry or [])).alias("_own")
    piece = F.col(key).cast("string") if path else F.lit(None).cast("string")
    rows = df.select(F.col(key).alias("_key"), F.col(parent).alias("_up"), F.lit(1).alias("_depth"), F.col(key).alias("_top"), piece.alias("_path"), own)
    step = materialize(rows, "pieces")
    most, length = step.count(), 1
    done, open_ = step.where("_up is null"), step.where("_up is not null")
    while not open_.isEmpty():
        if length > most:  # pieces longer than the table
            raise RecursionError(f"a cycle in {parent}")
        above = done.unionByName(open_).select(F.col("_key").alias("_up"), F.struct("_up", "_depth", "_top", "_path").alias("_a"))
        longer = open_.join(above, "_up").select(
            "_key", F.col("_a._up").alias("_up"), (F.col("_depth") + F.col("_a._depth")).alias("_depth"), F.col("_a._top").alias("_top"),
            F.concat("_path", F.lit(separator), "_a._path").alias("_path"), "_own",
        )
        step = materialize(longer, "pieces")
        done, open_, length = done.unionByName(step.where("_up is null")), step.where("_up is not null"), length * 2
    paths = [F.col("_path").alias(path)] if path else []
    return done.select(F.col("_key").alias(key), *paths, F.col("_depth").alias(depth), F.col("_top").alias(root), "_own.*")


def reachable(edges: DataFrame, start: DataFrame, src: str = "src", dst: str = "dst", node: str = "node") -> DataFrame:
    """Nodes reached from the start nodes, cycles allowed."""
    links = materialize(edges.select(src, dst).distinct(), "edges")

    def step(last: DataFrame) -> DataFrame:
        return links.join(last.withColumnRenamed(node, src), src).select(dst)

    return recurse(start.select(node), step)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the least node of the component) for the nodes of edges ``a, b``.

    Each step renames every node to its least neighbour and keeps the edges that
    still have two ends: a star is done after one step, a chain after a logarithm
    of its length.
    """
    edges = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        step = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("up")), "step")
        if roots is None:
            roots = step.withColumnRenamed("up", "root")
        else:
            roots = roots.join(step.select(F.col("node").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        roots = materialize(roots, "roots")
        new = edges.join(step.select(F.col("node").alias("a"), F.col("up").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        edges = materialize(new.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

"""Data layouts that serve the queries an index would serve."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.scale import cols, pg_order


# -- sorted layout ------------------------------------------------------

def clustered(df: DataFrame, order: Sequence[str | Column], spread: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Rows in key order over the whole table, as one range per task.

    Parquet keeps least and greatest values per row group, so later filters on
    the key skip most of the files. ``spread`` columns follow the key in the
    sort: they let Spark cut a key value with very many rows into several tasks.
    """
    order = [pg_order(o) for o in (*order, *spread)]
    parts = (width,) if width else ()
    return df.repartitionByRange(*parts, *order).sortWithinPartitions(*order)


# -- buckets, computed columns, subsets -----------------------------------

def bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int, location: str) -> None:
    """Write a catalog table bucketed and sorted by key: joins and groups on the
    key then need no shuffle of it."""
    (
        df.write.bucketBy(buckets, *cols(key)).sortBy(*cols(key)).option("path", location)
        .mode("overwrite").saveAsTable(table)
    )


def with_computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Store the value of a function, so filters on it reach the scan."""
    return df.withColumns(dict(columns))


def subset(df: DataFrame, where: Column, key: Sequence[str]) -> DataFrame:
    """The rows a partial index would hold."""
    return df.where(where).select(*key)


POSTING_WIDTH = 4096


# -- postings -----------------------------------------------------------

def tokens(text: Column) -> Column:
    """Lower-case words, split at blanks, tabs and line ends."""
    return F.filter(F.split(F.lower(text), "[ \\t\\r\\n]+"), lambda t: t != "")


def postings(df: DataFrame, key: str, text: str | None = None, array: str | None = None) -> DataFrame:
    """Inverted index as rows ``(token, key)``.

    Rows, not lists: the postings of a frequent token stay spread over tasks.
    Repeats inside one text go before the explode, so no shuffle is needed.
    """
    terms = tokens(F.col(text)) if text else F.col(array)
    return df.select(F.explode(F.array_distinct(terms)).alias("token"), key)


def store_postings(index: DataFrame, key: str, path: str, width: int = POSTING_WIDTH) -> None:
    """Store rows ``(token, key)`` as blocks ``(token, part, n, offsets)``, sorted by token.

    A block holds the keys of one token in one range of ``width`` keys (``part``), as
    offsets from the start of the range, two bytes each. So no block has more than
    ``width`` keys, however frequent its token.
    """
    if width > 1 << 15:
        raise ValueError("offsets of two bytes take ranges of at most 32,768 keys")
    part = F.floor(F.col(key) / width).cast("bigint")
    offset = (F.col(key) - part * width).cast("smallint")
    blocks = index.groupBy("token", part.alias("part")).agg(F.array_sort(F.collect_set(offset)).alias("offsets"))
    rows = blocks.select("token", "part", F.size("offsets").alias("n"), "offsets", F.lit(width).alias("width"))
    clustered(rows, ["token"], ["part"]).write.parquet(path)


def search_postings(blocks: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``query, key``: the rows that hold all tokens of each query, from ``wanted`` (``query, token``).

    Rarest first: the rarest token of a query names the ranges of keys; the blocks of its
    other tokens are taken in these ranges only, and a range is done when one of them has
    no block there. Blocks of one range meet, so a task holds a few blocks at a time.
    """
    wanted = wanted.distinct()
    known = blocks.join(wanted.select("token").distinct(), "token", "left_semi")
    counts = known.groupBy("token").agg(F.sum("n").alias("n"))
    # A query with a token that no row has is dropped here.
    terms = wanted.join(counts, "token", "left").groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("terms"))
    terms = terms.where(F.forall("terms", lambda t: t["n"].isNotNull()))
    rarest = terms.select("query", F.col("terms")[0]["token"].alias("token"), F.size("terms").alias("_terms"))
    places = rarest.join(known.select("token", "part"), "token").select("query", "part", "_terms")
    asked = terms.select("query", F.explode("terms.token").alias("token")).join(places, "query")
    met = asked.join(known.select("token", "part", "n", "offsets", "width"), ["token", "part"])
    smallest = F.array_sort(F.collect_list(F.struct("n", "offsets")))
    met = met.groupBy("query", "part", "_terms", "width").agg(smallest.alias("_b")).where(F.size("_b") == F.col("_terms"))
    common = F.aggregate(F.slice("_b", 2, F.size("_b")), F.col("_b")[0]["offsets"], lambda done, b: F.array_intersect(done, b["offsets"]))
    found = met.select("query", "part", "width", F.explode(common).alias("_offset"))
    return found.select("query", (F.col("part") * F.col("width") + F.col("_offset")).alias(key))


# -- neighbours -----------------------------------------------------------

def distance(vector: Column, point: Sequence[float]) -> Column:
    """Euclidean distance to a fixed point."""
    squares = F.zip_with(
        vector, F.array(*[F.lit(float(x)) for x in point]), lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))


def nearest(df: DataFrame, vector: str, key: str, point: Sequence[float], k: int) -> DataFrame:
    """The k rows nearest to a point; each task keeps k, so nothing is shuffled
    but the candidates. Ties go to the smaller key."""
    near = df.select(key, distance(F.col(vector), point).alias("distance"))
    return near.orderBy("distance", key).limit(k)

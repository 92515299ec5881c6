"""Query operators with the null order and set rules of the table engine.

Plain projection, comparison and arithmetic need no wrapper: use Column
expressions. The functions here fix the points where Spark's defaults differ.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.scale import cols, number_rows, pg_order, spread_join


# -- rows ---------------------------------------------------------------

def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows with declared types."""
    return spark.createDataFrame(rows, schema)


def one_row(spark: SparkSession, **exprs: Column) -> DataFrame:
    """SELECT without FROM."""
    return spark.range(1).select(*[e.alias(n) for n, e in exprs.items()])


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


# -- predicates ---------------------------------------------------------

def half_open(value: Column, low, high) -> Column:
    """``low <= value < high``; a bound of None is open."""
    terms = ([value >= low] if low is not None else []) + ([value < high] if high is not None else [])
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def is_true(predicate: Column) -> Column:
    """A predicate with unknown as false, for use under a negation.

    ``where`` drops unknown by itself, and only a bare predicate reaches the scan.
    """
    return F.coalesce(predicate, F.lit(False))


def bands(value: Column, limits: Sequence, labels: Sequence) -> Column:
    """First band whose upper limit is above the value, else the last label."""
    if len(labels) != len(limits) + 1:
        raise ValueError("need one label more than limits")
    out = F
    for limit, label in zip(limits, labels):
        out = out.when(value < F.lit(limit), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


# -- joins --------------------------------------------------------------

def any_of(df: DataFrame, column: str, key_rows: DataFrame, key: str | None = None) -> DataFrame:
    """``column = any(array)``, with the array kept as a frame of keys."""
    keys = key_rows.select(F.col(key or column).alias(column)).distinct()
    return spread_join(df, keys, column, "left_semi")


def exists(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with a match in ``other``."""
    return spread_join(df, other.select(*cols(on)).distinct(), on, "left_semi")


def missing(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` with no match in ``other``."""
    return spread_join(df, other.select(*cols(on)).distinct(), on, "left_anti")


# -- groups -------------------------------------------------------------

def group_count(df: DataFrame, by: str | Sequence[str], column: str, name: str = "cnt", more_than: int | None = None) -> DataFrame:
    """Count non-null values per group; keep groups with more than a number."""
    out = df.groupBy(*cols(by)).agg(F.count(column).alias(name))
    return out if more_than is None else out.where(F.col(name) > more_than)


def least_and_greatest(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column given by name."""
    return df.agg(F.min(column).alias("least"), F.max(column).alias("greatest"))


# -- order and pages ----------------------------------------------------

def ordered(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort with nulls last when rising and first when falling (``-name``)."""
    return df.orderBy(*[pg_order(o) for o in order])


def page(df: DataFrame, order: Sequence[str | Column], offset: int, limit: int) -> DataFrame:
    """OFFSET and LIMIT of an ordered set; runs as a top-k, not a full sort."""
    return ordered(df, *order).offset(offset).limit(limit)


def batches(keys: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """Put keys in rounds 1, 2 .. of ``size`` each."""
    numbered = number_rows(keys, order, "_n", start=0)
    return numbered.withColumn(name, F.expr(f"_n div {int(size)} + 1")).drop("_n")


# -- sets ---------------------------------------------------------------

def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Mapping[str, DataFrame], tag: str | None = None) -> DataFrame:
    """Union of tables by column name; columns a table lacks are null."""
    tagged = [df.withColumn(tag, F.lit(name)) if tag else df for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


# -- single row reads ---------------------------------------------------

class NoDataFound(ValueError):
    pass


class TooManyRows(ValueError):
    pass


def strict_one(df: DataFrame):
    """The only row, or an error; looks at two rows at most."""
    rows = df.limit(2).collect()
    if not rows:
        raise NoDataFound("query returned no rows")
    if len(rows) > 1:
        raise TooManyRows("query returned more than one row")
    return rows[0]


def first_or_none(df: DataFrame):
    return df.first()

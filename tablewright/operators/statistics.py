"""Statistics of tables and column groups, and throughput figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.scale import cols, pg_order


def ndistinct(df: DataFrame, groups: Mapping[str, Sequence[str]], exact: bool = True) -> DataFrame:
    """Distinct combinations per column group as ``(columns, n)``.

    A null counts as a value of its group. The estimate needs one pass and no
    shuffle of values.
    """
    order = list(groups)

    def one(names: Sequence[str]) -> Column:
        return F.count_distinct(F.struct(*names)) if exact else F.approx_count_distinct(F.xxhash64(*names), 0.01)

    row = df.agg(*[one(groups[g]).alias(f"g{i}") for i, g in enumerate(order)])
    pairs = F.array(*[F.struct(F.lit(g).alias("columns"), F.col(f"g{i}").alias("n")) for i, g in enumerate(order)])
    return row.select(F.explode(pairs).alias("x")).select("x.*")


def most_common(df: DataFrame, columns: str | Sequence[str], k: int = 100) -> DataFrame:
    """The k most frequent combinations with count and share of all rows.

    Ties go to the smaller value. Counts are exact: grouping is partial first,
    and the choice of k runs as a top-k.
    """
    columns = cols(columns)
    counts = df.groupBy(*columns).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("share", F.round(F.col("n") / total, 6)).orderBy(
        F.col("n").desc(), *[pg_order(c) for c in columns]
    ).limit(k)


def dependency(df: DataFrame, left: str | Sequence[str], right: str | Sequence[str]) -> DataFrame:
    """Share of rows whose left value goes with a single right value."""
    left, right = cols(left), cols(right)
    pairs = df.groupBy(*left, *right).agg(F.count("*").alias("n"))
    per_left = pairs.groupBy(*left).agg(F.sum("n").alias("n"), F.count("*").alias("rights"))
    return per_left.agg(
        F.round(F.sum(F.when(F.col("rights") == 1, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("degree")
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per column: rows, nulls, least, greatest, distinct values."""
    columns = list(columns or df.columns)
    aggs = [F.count("*").alias("_rows")]
    for i, c in enumerate(columns):
        distinct = F.count_distinct(c) if exact else F.approx_count_distinct(c, 0.01)
        aggs += [
            (F.count("*") - F.count(c)).alias(f"nulls{i}"),
            F.min(c).cast("string").alias(f"min{i}"),
            F.max(c).cast("string").alias(f"max{i}"),
            distinct.alias(f"distinct{i}"),
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("rows"),
            F.col(f"nulls{i}").alias("nulls"),
            F.col(f"min{i}").alias("least"),
            F.col(f"max{i}").alias("greatest"),
            F.col(f"distinct{i}").alias("distinct_values"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*lines)).alias("x")).select("x.*")


def concurrency(df: DataFrame, time: str, latency: str, bucket: str = "hour", seconds: int = 3600) -> DataFrame:
    """Little's law per time bucket: requests in flight = rate x latency."""
    return (
        df.groupBy(F.date_trunc(bucket, F.col(time)).cast("timestamp_ntz").alias("bucket"))
        .agg(F.count("*").alias("requests"), F.avg(F.col(latency)).alias("latency"))
        .withColumn("throughput", F.col("requests") / F.lit(seconds))
        .withColumn("concurrency", F.col("throughput") * F.col("latency"))
    )

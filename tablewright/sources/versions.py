"""Stored versions of a table with a tree of digests, and differences that read only what differs.

A version is stored as one folder per range of keys. Integer keys (their first column) are cut
every `width` values, so unique keys give a range at most `width` rows and appended rows touch
the last ranges only; other keys are cut by their hash into `width` ranges. A range's digest is
its number of rows and two sums of row hashes; FAN ranges make a range of the next level.

Two versions are compared from the top level down, each time within ranges that differ. Rows
are read from the leaves that differ, by a filter on the folders. Equal digests of unlike rows
need two sums of 64-bit hashes with different seeds to agree at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from tablewright.operators.scale import cols

WIDTH = 1 << 20
FAN = 64
LEVELS = 4
_ALL = "decimal(38,0)"
_DIGESTS = f"range bigint, n bigint, h1 {_ALL}, h2 {_ALL}, level int"


def _leaf(df: DataFrame, key: list[str], width: int) -> Column:
    if isinstance(df.schema[key[0]].dataType, IntegralType):
        return F.floor(F.coalesce(F.col(key[0]), F.lit(0)) / width).cast("bigint")
    return F.pmod(F.xxhash64(*key), F.lit(width)).cast("bigint")


class Version:
    """A stored version: `rows` as they were, `digests` of its ranges."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], schema: StructType):
        self.spark, self.path, self.key, self.schema = spark, path, cols(key), schema

    @property
    def stored(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields, StructField("_leaf", LongType())])).parquet(f"{self.path}/rows")

    @property
    def rows(self) -> DataFrame:
        return self.stored.select(*self.schema.names)

    @property
    def digests(self) -> DataFrame:
        return self.spark.read.schema(_DIGESTS).parquet(f"{self.path}/digests")

    def within(self, ranges: Sequence[int]) -> DataFrame:
        """The rows of some ranges; only their folders are read."""
        return self.stored.where(F.col("_leaf").isin(list(ranges))).select(*self.schema.names)


def store(df: DataFrame, path: str, key: str | Sequence[str], width: int = WIDTH) -> Version:
    """Write a version of a table. Two versions to compare take one width."""
    spark, key, columns = df.sparkSession, cols(key), df.columns
    if "_leaf" in columns:
        raise ValueError("_leaf is the name of the ranges")
    # Rebalanced, so that Spark splits a range that is larger than a task should write.
    df.withColumn("_leaf", _leaf(df, key, width)).hint("rebalance", "_leaf").write.partitionBy("_leaf").parquet(f"{path}/rows")
    version = Version(spark, path, key, df.schema)
    # Whether a value is null counts too, as nulls leave a hash as it is.
    values = [v for c in columns for v in (F.col(c), F.col(c).isNull())]
    own = [F.sum(F.xxhash64(F.lit(seed), *values).cast(_ALL)).cast(_ALL).alias(f"h{seed}") for seed in (1, 2)]
    level = version.stored.groupBy(F.col("_leaf").alias("range")).agg(F.count("*").alias("n"), *own)
    for at in range(LEVELS):
        level.withColumn("level", F.lit(at)).write.mode("append").partitionBy("level").parquet(f"{path}/digests")
        sums = [F.sum(F.xxhash64("range", h).cast(_ALL)).cast(_ALL).alias(h) for h in ("h1", "h2")]
        level = version.digests.where(F.col("level") == at).groupBy(F.floor(F.col("range") / FAN).cast("bigint").alias("range")).agg(F.sum("n").alias("n"), *sums)
    return version


def differing(before: Version, after: Version) -> list[int]:
    """The leaves that differ. They are folders, which the driver lists anyway when it reads a version."""
    found = None
    for at in reversed(range(LEVELS)):
        sides = []
        for version in (before, after):
            own = version.digests.where(F.col("level") == at).select("range", F.struct("n", "h1", "h2").alias("d"))
            if found is not None:
                own = own.join(found, F.floor(own["range"] / FAN) == found["above"], "left_semi")
            sides.append(own)
        both = sides[0].join(sides[1].withColumnRenamed("d", "e"), "range", "full_outer").where(~F.col("d").eqNullSafe(F.col("e")))
        found = both.select(F.col("range").alias("above"))
    return sorted(r.above for r in found.collect())

"""Partitioned tables as folders of Parquet, one folder per partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import partitions
from tablewright.operators.partitions import PART
from tablewright.operators.rules import RuleViolation
from tablewright.plans.tabledef import Part, PartitionSpec


def write(rows: DataFrame, spec: PartitionSpec, path: str) -> None:
    """Insert rows into their partitions; a row that fits nowhere fails them all."""
    partitions.route_checked(rows, spec).write.mode("append").partitionBy(PART).parquet(path)


def read(spark: SparkSession, path: str, spec: PartitionSpec, low=None, high=None, closed: bool = True) -> DataFrame:
    """Rows with the key in ``low..high``, from the folders that can hold them."""
    rows = spark.read.option("inferSchema", "false").parquet(path)
    if low is None and high is None:
        return rows.drop(PART)
    return partitions.pruned(rows, spec, low, high, closed).drop(PART)


def read_part(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of one partition; no other folder is read."""
    return spark.read.parquet(path).where(F.col(PART) == name).drop(PART)


def without_part(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table after one partition is dropped."""
    return spark.read.parquet(path).where(F.col(PART) != name).drop(PART)


def replace_part(rows: DataFrame, spec: PartitionSpec, name: str, path: str) -> None:
    """Exchange the rows of one partition; rows that do not belong there fail."""
    partitions.check_rows(rows, spec.part(name), spec)
    tagged = rows.withColumn(PART, F.lit(name))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def attach(rows: DataFrame, part: Part, spec: PartitionSpec, path: str) -> PartitionSpec:
    """Add a partition with its rows, checked against its bounds and the default partition's rows."""
    grown = spec.with_part(part)
    partitions.check_spec(grown)
    partitions.check_rows(rows, part, grown)
    for other in (p for p in spec.parts if p.default):
        if not partitions.attach_overlap(read_part(rows.sparkSession, path, other.name), part, grown).isEmpty():
            raise RuleViolation(f"rows of {other.name} belong to {part.name}")
    rows.withColumn(PART, F.lit(part.name)).write.mode("append").partitionBy(PART).parquet(path)
    return grown

"""Logical export and restore of tables, and full plus incremental copies."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.sources import copy_text
from tablewright.sources.versions import Version
from tablewright.streaming import changes


def export(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each table's schema and rows, as COPY text."""
    for name, rows in tables.items():
        copy_text.write(rows, f"{path}/{name}/rows")
        rows.sparkSession.range(1).select(F.lit(rows.schema.json())).coalesce(1).write.text(f"{path}/{name}/schema")


def restore(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One table of an export."""
    schema = spark.read.text(f"{path}/{name}/schema").first()[0]
    return copy_text.read(spark, f"{path}/{name}/rows", StructType.fromJson(json.loads(schema)))


def increment(before: Version, after: Version, number: int) -> DataFrame:
    """What changed between two stored versions, as the increment with a number."""
    return changes.diff_versions(before, after).withColumn("lsn", F.lit(number).cast("bigint"))


def combine(full: DataFrame, increments: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """The table after a full copy and its increments, given in any order."""
    log = increments[0]
    for more in increments[1:]:
        log = log.unionByName(more)
    return changes.apply_changes(full, log, key, truncates=False)

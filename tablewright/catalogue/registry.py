"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables by name: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """List a function of the tables under its name, with the SQL that gives the same rows."""

    def listed(make: Callable[[Tables], DataFrame]):
        QUERIES[make.__name__] = lambda spark, folder: make(Tables(spark, folder))
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make

    return listed

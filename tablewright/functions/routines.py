"""Functions and procedures of the session, as Spark SQL routines."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def scalar_function(
    spark: SparkSession, name: str, params: Mapping[str, str | tuple[str, Any]], returns: str, body: str
) -> None:
    """Create a scalar SQL function.

    ``params`` maps a name to its type, or to (type, default as SQL). Calls may
    name their arguments: ``f(b => 3)``. The body is inlined in the plan.
    """
    listed = ", ".join(
        f"{p} {t}" if isinstance(t, str) else f"{p} {t[0]} DEFAULT {t[1]}" for p, t in params.items()
    )
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({listed}) RETURNS {returns} RETURN {body}")


def table_function(
    spark: SparkSession, name: str, columns: Mapping[str, str], query: str, params: Mapping[str, str] | None = None
) -> None:
    """Create a function that returns rows; its columns bind by position."""
    given = ", ".join(f"{p} {t}" for p, t in (params or {}).items())
    made = ", ".join(f"{c} {t}" for c, t in columns.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({given}) RETURNS TABLE ({made}) RETURN {query}")


def set_function(spark: SparkSession, name: str, like: DataFrame, query: str) -> None:
    """Create a function that returns rows of an existing row type."""
    table_function(spark, name, {f"`{f.name}`": f.dataType.simpleString() for f in like.schema}, query)


def drop_function(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")


def by_name(spark: SparkSession, query: str, **names: str) -> DataFrame:
    """Run a query whose tables and columns are given by name: IDENTIFIER(:t)."""
    return spark.sql(query, args=names)

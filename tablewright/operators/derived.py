"""Views, stored query results, audit rows and rules that fire on changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.scale import cols, number_rows, spread_join
from tablewright.session import materialize

OPERATIONS = {"I": "INSERT", "U": "UPDATE", "D": "DELETE", "T": "TRUNCATE"}


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


class StoredView:
    """A query result kept as Parquet; stale until it is refreshed.

    Each refresh writes a folder of its own, so readers of the one before are
    not disturbed.
    """

    def __init__(self, spark: SparkSession, query: Callable[[], DataFrame]):
        self.spark, self.query, self.rows = spark, query, None

    def refresh(self) -> DataFrame:
        """Run the query again and keep its result."""
        self.rows = materialize(self.query(), "view")
        return self.rows

    def read(self) -> DataFrame:
        return self.refresh() if self.rows is None else self.rows


# -- audit ----------------------------------------------------------------

def operation_name(op: Column) -> Column:
    out = F
    for short, long in OPERATIONS.items():
        out = out.when(op == short, F.lit(long))
    return out


def audit_rows(
    changes: DataFrame,
    key: str,
    entry_date: Column,
    ops: Sequence[str] = ("I",),
    when: Callable[[Column, Column], Column] | None = None,
    number: str | None = None,
    last: int = 0,
) -> DataFrame:
    """One row per changed row: key, date, operation.

    ``number`` names a serial column for them, after ``last``, in order of key.

    ``when`` takes the old and new row and says which changes count.
    """
    rows = changes.where(F.col("op").isin(list(ops)))
    if when is not None:
        rows = rows.where(when(F.col("old"), F.col("new")))
    out = rows.select(
        F.coalesce(F.col(f"new.{key}"), F.col(f"old.{key}")).alias(key),
        entry_date.alias("entry_date"),
        operation_name(F.col("op")).alias("operation"),
    )
    return out if number is None else number_rows(out, [key, "operation"], number, start=last + 1)


def audit_images(changes: DataFrame, ops: Sequence[str] = ("I", "U", "D")) -> DataFrame:
    """Old and new row of each change."""
    return changes.where(F.col("op").isin(list(ops))).select(operation_name(F.col("op")).alias("operation"), "old", "new")


def audit_statement(changes: DataFrame, op: str, entry_date: Column) -> DataFrame:
    """One row per statement, also when it changed nothing."""
    return changes.where(F.col("op") == op).agg(
        F.lit(OPERATIONS[op]).alias("operation"), F.count("*").alias("rows")
    ).withColumn("entry_date", entry_date)


def audit_deferred(
    changes: DataFrame, final: DataFrame, key: str | Sequence[str], entry_date: Column, ops: Sequence[str] = ("I",)
) -> DataFrame:
    """Audit at commit: only rows that still exist count."""
    key = cols(key)
    rows = changes.where(F.col("op").isin(list(ops))).select(
        *[F.col(f"new.{k}").alias(k) for k in key], operation_name(F.col("op")).alias("operation")
    )
    alive = spread_join(rows, final.select(*key).distinct(), key, "left_semi")
    return alive.select(*key, entry_date.alias("entry_date"), "operation")


# -- rules that fire on changes ---------------------------------------------

@dataclass(frozen=True)
class Rule:
    """On changes of ``table``, make changes of other tables.

    ``action`` takes the change rows and returns change rows per table.
    ``below_depth`` 1 fires on user changes only, 2 also on what those fire.
    """

    name: str
    table: str
    action: Callable[[DataFrame], Mapping[str, DataFrame]]
    ops: tuple[str, ...] = ("I", "U", "D")
    when: Callable[[Column, Column], Column] | None = None
    below_depth: int = 1


def fire(changes: Mapping[str, DataFrame], rules: Sequence[Rule], disabled: Sequence[str] = ()) -> dict[str, list[DataFrame]]:
    """All change rows of a user change, those of the rules included.

    A rule fires on changes above its depth only, so the levels end with the
    greatest ``below_depth``; no job runs while the plan is built.
    """
    done: dict[str, list[DataFrame]] = {t: [c] for t, c in changes.items()}
    pending, depth = {t: [c] for t, c in changes.items()}, 0
    active = [r for r in rules if r.name not in disabled and f"{r.table}.{r.name}" not in disabled]
    while pending:
        produced: dict[str, list[DataFrame]] = {}
        for rule in active:
            if depth >= rule.below_depth or rule.table not in pending:
                continue
            rows = reduce(DataFrame.unionByName, pending[rule.table]).where(F.col("op").isin(list(rule.ops)))
            if rule.when is not None:
                rows = rows.where(rule.when(F.col("old"), F.col("new")))
            for table, more in rule.action(rows).items():
                produced.setdefault(table, []).append(more)
                done.setdefault(table, []).append(more)
        pending, depth = produced, depth + 1
    return done

"""Rules as violation queries: an empty frame means the rule holds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.scale import cols
from tablewright.plans.tabledef import TableDef


class RuleViolation(ValueError):
    """A change broke a rule; nothing was committed."""


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in a column that must not be null."""
    broken = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    return df.withColumn("null_columns", broken).where(F.size("null_columns") > 0)


def unique_violations(df: DataFrame, key: str | Sequence[str], primary: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count.

    A unique key with a null never clashes; a primary key may not hold nulls,
    which is the not-null rule's business. Counts are partial first, so one key
    in a third of the rows sends one row per task.
    """
    key = cols(key)
    rows = df if primary else df.dropna(subset=key)
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, columns: str | Sequence[str], references: str | Sequence[str]
) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    The child rows are grouped by key before the join, so a hot key does not
    load one task. Keys with a null are exempt.
    """
    columns, references = cols(columns), cols(references)
    keys = child.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n"))
    known = parent.select(*[F.col(r).alias(c) for c, r in zip(columns, references)])
    return keys.join(known, columns, "left_anti")


def check_violations(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which a CHECK is false; unknown passes."""
    return df.where(~F.coalesce(F.expr(expression), F.lit(True)))


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its limit."""
    too_long = [F.length(c) > n for c, n in limits.items()]
    return df.where(F.coalesce(F.array_contains(F.array(*[F.coalesce(t, F.lit(False)) for t in too_long]), True), F.lit(False)))


def violations(
    df: DataFrame,
    definition: TableDef,
    others: Mapping[str, DataFrame] | None = None,
    extra: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    deferred: bool = True,
) -> DataFrame:
    """All broken rules of a table as ``(rule, n)``.

    Row rules (null, length, check) share one pass over the table. ``deferred``
    false leaves out the deferrable rules, as a statement check does. ``extra``
    holds rules that need a query of their own.
    """
    others = others or {}
    off = set(definition.disabled_rules)
    flags = {}
    required = dict.fromkeys((*definition.not_null, *[c for u in definition.uniques if u.primary for c in u.columns]))
    for c in required:
        flags[f"not_null({c})"] = F.col(c).isNull()
    for c, n in definition.lengths.items():
        flags[f"length({c})"] = F.coalesce(F.length(c) > n, F.lit(False))
    for check in (c for c in definition.checks if c.name not in off):
        flags[check.name] = ~F.coalesce(F.expr(check.expression), F.lit(True))
    found = []
    if flags:
        # Positional names: rule names may hold any character.
        order = list(flags)
        counted = df.agg(*[F.count_if(flags[r]).alias(f"r{i}") for i, r in enumerate(order)])
        pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"r{i}").alias("n")) for i, r in enumerate(order)]))
        found.append(counted.select(pairs.alias("x")).select("x.rule", "x.n").where("n > 0"))
    for u in (u for u in definition.uniques if u.label not in off):
        if deferred or not u.deferrable:
            bad = unique_violations(df, u.columns, u.primary)
            found.append(bad.agg(F.lit(u.label).alias("rule"), F.count("*").alias("n")).where("n > 0"))
    for fk in (f for f in definition.foreign_keys if f.label not in off):
        if (deferred or not fk.deferrable) and fk.table in others:
            bad = foreign_key_violations(df, others[fk.table], fk.columns, fk.references)
            found.append(bad.agg(F.lit(fk.label).alias("rule"), F.count("*").alias("n")).where("n > 0"))
    for name, rule in ((n, r) for n, r in (extra or {}).items() if n not in off):
        found.append(rule(df).agg(F.lit(name).alias("rule"), F.count("*").alias("n")).where("n > 0"))
    if not found:
        return df.sparkSession.createDataFrame([], "rule string, n bigint")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def enforce(df: DataFrame, definition: TableDef, **kwargs) -> DataFrame:
    """Raise on a broken rule; the report has one row per rule."""
    broken = {r["rule"]: r["n"] for r in violations(df, definition, **kwargs).collect()}
    if broken:
        raise RuleViolation(f"{definition.name}: {broken}")
    return df

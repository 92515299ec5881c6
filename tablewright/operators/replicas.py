"""Mergeable replica states (conflict-free replicated data types).

Each input row is what one replica knew at some time. Every merge is a grouped
aggregate that is commutative, associative and idempotent, so Spark may merge
partial results in any order, and rows that arrive twice change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.scale import cols


def g_counter(states: DataFrame, key: str | Sequence[str], replica: str, value: str, name: str = "total") -> DataFrame:
    """Grow-only counter: the largest count per replica, summed."""
    key = cols(key)
    merged = states.groupBy(*key, replica).agg(F.max(value).alias("_v"))
    return merged.groupBy(*key).agg(F.sum("_v").alias(name))


def pn_counter(
    states: DataFrame, key: str | Sequence[str], replica: str, plus: str, minus: str, name: str = "total"
) -> DataFrame:
    """Counter with decrements: two grow-only counters."""
    key = cols(key)
    merged = states.groupBy(*key, replica).agg(F.max(plus).alias("_p"), F.max(minus).alias("_m"))
    return merged.groupBy(*key).agg((F.coalesce(F.sum("_p"), F.lit(0)) - F.coalesce(F.sum("_m"), F.lit(0))).alias(name))


def g_set(states: DataFrame, key: str | Sequence[str], element: str) -> DataFrame:
    """Grow-only set, kept as rows: a set of any size stays distributed."""
    return states.select(*cols(key), element).distinct()


def g_map(states: DataFrame, key: str | Sequence[str], field: str, value: str) -> DataFrame:
    """Grow-only map whose values grow: largest value per field."""
    return states.groupBy(*cols(key), field).agg(F.max(value).alias(value))


def lww_map(
    states: DataFrame, key: str | Sequence[str], value: str, time: str, replica: str, deleted: str | None = None
) -> DataFrame:
    """Last writer wins; equal times go to the larger replica.

    ``deleted`` marks removals, which win over older writes. Use the field or
    the element as part of ``key`` for maps and sets.
    """
    key = cols(key)
    kept = [value, time, replica] + ([deleted] if deleted else [])
    # Equal time and replica can only be the same write; the value makes the
    # choice independent of the order of rows all the same.
    last = F.max(F.struct(time, replica, *[c for c in kept if c not in (time, replica)])).alias("_s")
    out = states.groupBy(*key).agg(last).select(*key, *[F.col(f"_s.{c}").alias(c) for c in kept])
    return out.where(~F.col(deleted)).drop(deleted) if deleted else out

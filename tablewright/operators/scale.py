"""Helpers that keep keyed work balanced when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.session import materialize

# Rows of one key that one task should hold; a key with more is cut into slots.
ROWS_PER_TASK = 1_000_000
# The sketch follows this many items exactly enough to name the largest keys.
SKETCH_KEYS = 4096
SKETCH_ITEMS = 262144
# First-round groups where partial results of all tasks are merged in two rounds.
FAN = 64


def cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def key_hash(keys: str | Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in cols(keys)])


def hot_keys(df: DataFrame, keys: str | Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> dict[int, int]:
    """Hashes of the keys with more than ``rows_per_task`` rows, and their number of slots.

    One pass with a mergeable frequent-items sketch: the tasks send sketches,
    never the distinct keys. The answer only steers the work, so its error
    cannot change a result.
    """
    top = df.select(key_hash(keys).alias("h")).agg(F.expr(f"approx_top_k(h, {SKETCH_KEYS}, {SKETCH_ITEMS})")).first()[0]
    return {t["item"]: -(-t["count"] // rows_per_task) for t in top or () if t["count"] > rows_per_task}


def is_hot(keys: str | Sequence[str], hot: Mapping[int, int]) -> Column:
    return key_hash(keys).isin(list(hot)) if hot else F.lit(False)


def slots_of(hot: Mapping[int, int]) -> int:
    """Slots that serve each of the hot keys."""
    return max(hot.values(), default=1)


def slot_of(value: Column, bounds: Sequence) -> Column:
    """Number of bounds that are at most ``value``, as a balanced CASE tree.

    Needs log2(len(bounds)) comparisons per row and stays in generated code.
    """

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def quantile_bounds(df: DataFrame, order: str, slots: int) -> list:
    """At most ``slots - 1`` rising cut points that split a column evenly."""
    shares = [i / slots for i in range(1, slots)]
    if not shares:
        return []
    points = df.agg(F.percentile_approx(order, shares, 10 * slots)).first()[0] or []
    return sorted(set(points))


def previous_value(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    value: Column,
    name: str,
    when: Column | None = None,
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Add the ``value`` of the last earlier row of the same key.

    Earlier means a smaller ``order``; with ``when`` only rows that satisfy it
    count. ``order`` must be numeric or a time, and unique per key. ``value``
    may be null.

    A key with few rows is one window group. A hot key is cut into slots of
    equal size along ``order``: each slot is a group of its own, and the value
    that enters a slot comes from one summary row per slot. The summaries
    number at most (hot keys x slots).
    """
    keys = cols(keys)
    marked = F.when(when if when is not None else F.lit(True), F.struct(value.alias("v")))
    hot = hot_keys(df, keys) if hot is None else hot
    full = df.withColumn("_mark", marked)
    if not hot:
        before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        out = full.withColumn(name, F.last("_mark", ignorenulls=True).over(before)["v"])
        return out.drop("_mark")

    flag = is_hot(keys, hot)
    bounds = quantile_bounds(df.where(flag), order, slots_of(hot))
    # A struct key compares null keys as equal, and lets the join and the window
    # below share one shuffle.
    full = full.withColumn("_key", F.struct(*keys)).withColumn(
        "_slot", F.when(flag, slot_of(F.col(order), bounds)).otherwise(F.lit(0))
    )
    ends = (
        full.where(flag)
        .groupBy("_key", "_slot")
        .agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col(order))).alias("_end"))
    )
    over_slots = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    enter = ends.select(
        "_key", "_slot", F.last("_end", ignorenulls=True).over(over_slots).alias("_enter")
    ).where(F.col("_enter").isNotNull())
    before = Window.partitionBy("_key", "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = F.coalesce(F.last("_mark", ignorenulls=True).over(before), F.col("_enter"))
    return (
        full.join(enter, ["_key", "_slot"], "left")
        .withColumn(name, found["v"])
        .select(*df.columns, name)
    )


def spread_join(
    big: DataFrame,
    keyed: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Join a side with repeated keys to a side with unique keys.

    Rows of hot keys are spread over groups of about ROWS_PER_TASK, and only the
    hot rows of the keyed side are repeated, once per group. ``how`` keeps the
    left side: inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} does not keep the repeated side")
    on = cols(on)
    hot = hot_keys(big, on) if hot is None else hot
    kept = big.columns if how in ("left_semi", "left_anti") else ["*"]
    if not hot:
        return big.join(keyed, on, how).select(*kept)
    salts = slots_of(hot)
    flag = is_hot(on, hot)
    # The input partition is the same when a task runs again, and spreads equal rows, too.
    salt = F.when(flag, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(F.lit(0)).cast("bigint")
    left = big.withColumn("_salt", salt)
    copies = F.when(flag, F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))).otherwise(
        F.array(F.lit(0).cast("bigint"))
    )
    right = keyed.withColumn("_salt", F.explode(copies))
    return left.join(right, [*on, "_salt"], how).drop("_salt").select(*kept)


def number_rows(df: DataFrame, order: Sequence[str | Column], name: str = "rn", start: int = 1) -> DataFrame:
    """Number rows 1, 2, 3 .. in a total order without one big window.

    The rows are range partitioned and sorted, written once, and each row then
    gets its place in its partition plus the size of the partitions before, which come
    from a frame of one row per partition. Nulls come last when rising and first
    when falling, as in the rest of the package.
    """
    order = [pg_order(o) for o in order]
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright(F.col("_at"), 33).cast("int")
    # One small row per partition: the numbered rows are not shuffled again, and the plan does not grow.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + start).alias("_first"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = placed.withColumn("_part", part).join(F.broadcast(first), "_part")
    return rows.withColumn(name, F.col("_first") + place).select(*df.columns, name)


def pg_order(item: str | Column) -> Column:
    """A sort term with nulls last when rising; ``-name`` falls, nulls first."""
    if isinstance(item, Column):
        return item
    if item.startswith("-"):
        return F.col(item[1:]).desc_nulls_first()
    return F.col(item).asc_nulls_last()

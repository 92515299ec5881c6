"""Rules checked for a change alone: only keys that the change touches are looked up.

A change is rows of `old` and `new` images (null where there is none). For a touched key

    rows after = rows before - old images + new images,

so the number after is known from the change and the rows before that have the key. All
images of one transaction are added up, which makes the check the deferred one: a key that is
taken and released again, or swapped, is judged as it stands at the end. What a check returns
is what the full check of the changed table would return, if the table kept the rule before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.scale import cols


def net(changes: DataFrame, columns: str | Sequence[str], names: str | Sequence[str] | None = None) -> DataFrame:
    """Keys that a change touches, with `_plus`, what it adds to their number of rows, and `_gains`, their new images."""
    columns = cols(columns)
    names = cols(names) if names else columns
    images = [
        F.struct(*[F.col(f"{side}.{c}").alias(n) for c, n in zip(columns, names, strict=True)], F.lit(sign).cast("bigint").alias("_sign"), F.col(side).isNotNull().alias("_is"))
        for side, sign in (("old", -1), ("new", 1))
    ]
    rows = changes.select(F.explode(F.array(*images)).alias("i")).select("i.*").where("_is").dropna(subset=names)
    return rows.groupBy(*names).agg(F.sum("_sign").alias("_plus"), F.count_if(F.col("_sign") == 1).alias("_gains"))


def after(before: DataFrame, touched: DataFrame, columns: Sequence[str], names: Sequence[str], plus: str) -> DataFrame:
    """touched with `_n`, the rows of each key after the change. Of the table, only the key columns are read."""
    keys = before.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)])
    held = keys.join(touched.select(*names), list(names), "left_semi").groupBy(*names).agg(F.count("*").alias("_held"))
    return touched.join(held, list(names), "left").withColumn("_n", F.coalesce("_held", F.lit(0)) + F.col(plus)).drop("_held")


def unique_violations(before: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once after the change, with their count. Keys with a null are exempt."""
    key = cols(key)
    touched = net(changes, key).where("_gains > 0 and _plus > 0")
    return after(before, touched, key, key, "_plus").where("_n > 1").select(*key, F.col("_n").alias("n"))


def foreign_key_violations(
    child: DataFrame, child_changes: DataFrame | None, parent: DataFrame, parent_changes: DataFrame | None, columns: str | Sequence[str], references: str | Sequence[str]
) -> DataFrame:
    """Child keys without a parent after changes of either table, with the number of child rows.

    Keys to look at: those that child rows gained and those that parents lost.
    """
    columns, references = cols(columns), cols(references)
    empty = child.select(*columns).limit(0).withColumns({"_plus": F.lit(0).cast("bigint"), "_gains": F.lit(0).cast("bigint")})
    gained = net(child_changes, columns) if child_changes is not None else empty
    lost = net(parent_changes, references, columns) if parent_changes is not None else empty
    both = gained.select(*columns, F.col("_plus").alias("_c"), F.col("_gains").alias("_cg"), F.lit(0).cast("bigint").alias("_p"))
    both = both.unionByName(lost.select(*columns, F.lit(0).cast("bigint").alias("_c"), F.lit(0).cast("bigint").alias("_cg"), F.col("_plus").alias("_p")))
    touched = both.groupBy(*columns).agg(F.sum("_c").alias("_c"), F.sum("_cg").alias("_cg"), F.sum("_p").alias("_p")).where("_cg > 0 or _p < 0")
    # Parents first: they decide, and few keys go on to the larger table.
    orphans = after(parent, touched, references, columns, "_p").where("_n <= 0").drop("_n")
    return after(child, orphans, columns, columns, "_c").where("_n > 0").select(*columns, F.col("_n").alias("n"))

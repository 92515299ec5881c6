"""Table changes as functions: old state in, new state and change rows out.

A change row is ``(op, old, new)`` with op I, U, D or T; ``old`` and ``new``
are structs of the whole row. Nothing is written here; see ``plans.store``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.relational import batches, is_true
from tablewright.operators.rules import RuleViolation
from tablewright.operators.scale import cols, number_rows, spread_join
from tablewright.plans.tabledef import Serial, TableDef
from tablewright.session import materialize


class Outcome(NamedTuple):
    state: DataFrame
    changes: DataFrame

    @property
    def removed(self) -> DataFrame:
        """RETURNING of a delete."""
        return self.changes.where("op = 'D'").select("old.*")

    @property
    def written(self) -> DataFrame:
        """RETURNING of an insert or update."""
        return self.changes.where("op in ('I', 'U')").select("new.*")


def row(df: DataFrame, prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}`{c}`").alias(c) for c in df.columns])


def no_row(df: DataFrame) -> Column:
    return F.lit(None).cast(df.schema.simpleString())


def _null_of(df: DataFrame) -> Column:
    return F.when(F.lit(False), row(df))


def conform(rows: DataFrame, definition: TableDef, columns: Sequence[str] | None = None) -> DataFrame:
    """Fit rows to a table: by position when ``columns`` names the targets,
    else by name; absent columns take their default."""
    if columns is not None:
        if len(columns) != len(rows.columns):
            raise ValueError(f"{len(columns)} target columns, {len(rows.columns)} values")
        rows = rows.toDF(*columns)
    unknown = set(rows.columns) - set(definition.schema.names)
    if unknown:
        raise ValueError(f"no such columns in {definition.name}: {sorted(unknown)}")
    out = []
    for f in definition.schema:
        if f.name in rows.columns:
            value = F.col(f.name)
        else:
            value = F.expr(definition.defaults.get(f.name, "null"))
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def insert(
    state: DataFrame, rows: DataFrame, definition: TableDef | None = None, columns: Sequence[str] | None = None
) -> Outcome:
    """Add rows, from literals or a query, with or without a column list."""
    if definition is not None:
        rows = conform(rows, definition, columns)
    elif columns is not None:
        rows = rows.toDF(*columns)
    elif set(rows.columns) != set(state.columns):
        rows = rows.toDF(*state.columns)  # positional
    changes = rows.select(F.lit("I").alias("op"), _null_of(rows).alias("old"), row(rows).alias("new"))
    return Outcome(state.unionByName(rows), changes)


def update(state: DataFrame, assign: Mapping[str, Column], where: Column | None = None) -> Outcome:
    """Set columns in the rows that satisfy ``where``, or in all rows."""
    hit = where if where is not None else F.lit(True)
    types = {f.name: f.dataType for f in state.schema}
    # All right-hand sides see the old row.
    fresh = [(assign[c].cast(types[c]) if c in assign else F.col(c)).alias(c) for c in state.columns]
    kept = [
        (F.when(hit, assign[c].cast(types[c])).otherwise(F.col(c)) if c in assign else F.col(c)).alias(c)
        for c in state.columns
    ]
    changes = state.where(hit).select(F.lit("U").alias("op"), row(state).alias("old"), F.struct(*fresh).alias("new"))
    return Outcome(state.select(*kept), changes)


def delete(state: DataFrame, where: Column) -> Outcome:
    """Remove rows; ``removed`` of the outcome is RETURNING."""
    changes = state.where(where).select(F.lit("D").alias("op"), row(state).alias("old"), _null_of(state).alias("new"))
    return Outcome(state.where(~is_true(where)), changes)


def delete_keys(state: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> Outcome:
    """Remove the rows whose key is in a frame of keys."""
    keys = keys.select(*cols(on)).distinct()
    gone = spread_join(state, keys, on, "left_semi")
    changes = gone.select(F.lit("D").alias("op"), row(state).alias("old"), _null_of(state).alias("new"))
    return Outcome(spread_join(state, keys, on, "left_anti"), changes)


def truncate(state: DataFrame) -> Outcome:
    spark = state.sparkSession
    changes = spark.range(1).select(
        F.lit("T").alias("op"), no_row(state).alias("old"), no_row(state).alias("new")
    )
    return Outcome(state.limit(0), changes)


def move(state: DataFrame, where: Column, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DELETE RETURNING into INSERT: both new states."""
    out = delete(state, where)
    return out.state, target.unionByName(out.removed.select(*target.columns))


# -- merge --------------------------------------------------------------

@dataclass(frozen=True)
class When:
    """One branch of a merge. Expressions name sides as ``t.x`` and ``s.x``."""

    action: str
    condition: Column | None = None
    values: Mapping[str, Column] | None = None


def matched_update(values: Mapping[str, Column], condition: Column | None = None) -> When:
    return When("update", condition, values)


def matched_delete(condition: Column | None = None) -> When:
    return When("delete", condition)


def matched_nothing(condition: Column | None = None) -> When:
    return When("keep", condition)


def unmatched_insert(values: Mapping[str, Column], condition: Column | None = None) -> When:
    return When("insert", condition, values)


def unmatched_nothing(condition: Column | None = None) -> When:
    return When("skip", condition)


class CardinalityViolation(RuleViolation):
    """Two source rows want to change the same target row."""


def _first_branch(branches: Sequence[When]) -> Column:
    out = F
    for i, b in enumerate(branches):
        out = out.when(is_true(b.condition) if b.condition is not None else F.lit(True), F.lit(i))
    return out.otherwise(F.lit(-1)) if branches else F.lit(-1)


def merge(
    target: DataFrame, source: DataFrame, on: Mapping[str, str], branches: Sequence[When], definition: TableDef | None = None
) -> Outcome:
    """MERGE: the first true branch decides for each row.

    The target is joined to the source, not the other way round, so a source
    that Spark can broadcast leaves the target unshuffled. The unmatched source
    rows come from a second join that reads only the key columns of the target.
    Both matches are written once, for the new state and the change rows alike.
    Columns that an insert branch leaves out take the default of ``definition``.
    """
    target = target.withColumn("_row", F.monotonically_increasing_id())
    on_match = [b for b in branches if b.action in ("update", "delete", "keep")]
    on_miss = [b for b in branches if b.action in ("insert", "skip")]
    acting = [i for i, b in enumerate(on_match) if b.action != "keep"]
    condition = F.lit(True)
    for left, right in on.items():
        condition = condition & (F.col(f"t.{left}") == F.col(f"s.{right}"))
    pick = F.when(F.col("s._hit").isNotNull(), _first_branch(on_match)).otherwise(F.lit(-1))

    columns = [c for c in target.columns if c != "_row"]
    types = {f.name: f.dataType for f in target.schema}
    defaults = {c: F.expr(definition.defaults.get(c, "null") if definition else "null").cast(types[c]) for c in columns}

    def new_value(c: str) -> Column:
        out, some = F, False
        for i, b in enumerate(on_match):
            if b.action == "update" and c in b.values:
                out, some = out.when(F.col("_pick") == i, b.values[c].cast(types[c])), True
        return (out.otherwise(F.col(f"t.{c}")) if some else F.col(f"t.{c}")).alias(c)

    old_row = F.struct(*[F.col(f"t.{c}").alias(c) for c in columns])
    new_row = F.struct(*[new_value(c) for c in columns])
    hits = source.withColumn("_hit", F.lit(True)).alias("s")
    matched = target.alias("t").join(hits, condition, "left").withColumn("_pick", pick)
    joined = materialize(matched.select(F.col("t._row").alias("_row"), "_pick", old_row.alias("old"), new_row.alias("new")), "merge")
    repeated = source.dropna(subset=list(on.values())).groupBy(*on.values()).count().where("count > 1")
    if not repeated.isEmpty():
        acts = joined.where(F.col("_pick").isin(acting))
        if not acts.groupBy("_row").count().where("count > 1").isEmpty():
            raise CardinalityViolation("a target row matches more than one source row")
        # The other repeats change nothing and must not repeat the target row.
        idle = joined.join(acts.select("_row"), "_row", "left_anti").dropDuplicates(["_row"])
        joined = acts.unionByName(idle)

    dropped = [i for i, b in enumerate(on_match) if b.action == "delete"]
    updated = [i for i, b in enumerate(on_match) if b.action == "update"]
    kept = joined.where(~F.col("_pick").isin(dropped)) if dropped else joined
    state = kept.select("new.*")
    changes = joined.where(F.col("_pick").isin(dropped + updated)).select(
        F.when(F.col("_pick").isin(dropped), "D").otherwise("U").alias("op"),
        "old",
        F.when(F.col("_pick").isin(updated), F.col("new")).alias("new"),
    )

    if on_miss:
        keys = list(on.values())
        wanted = source.select(*keys).distinct()
        present = target.select(*[F.col(left).alias(right) for left, right in on.items()]).join(wanted, keys, "left_semi")
        fresh = source.join(present, keys, "left_anti").alias("s").withColumn("_pick", _first_branch(on_miss))

        def inserted(c: str) -> Column:
            out, some = F, False
            for i, b in enumerate(on_miss):
                if b.action == "insert" and c in b.values:
                    out, some = out.when(F.col("_pick") == i, b.values[c].cast(types[c])), True
            return (out.otherwise(defaults[c]) if some else defaults[c]).alias(c)

        adding = [i for i, b in enumerate(on_miss) if b.action == "insert"]
        added = materialize(fresh.where(F.col("_pick").isin(adding)).select(*[inserted(c) for c in columns]), "merge")
        state = state.unionByName(added)
        changes = changes.unionByName(
            added.select(F.lit("I").alias("op"), _null_of(added).alias("old"), row(added).alias("new"))
        )
    return Outcome(state, changes)


def upsert(
    state: DataFrame,
    rows: DataFrame,
    key: str | Sequence[str],
    assign: Mapping[str, Column] | None = None,
    remote: bool = False,
    definition: TableDef | None = None,
) -> Outcome:
    """INSERT ON CONFLICT. Without ``assign`` a conflict does nothing; with it
    the row is updated, ``s.x`` being EXCLUDED. A key with a null never
    conflicts. Of rows with one new key the least is inserted."""
    key = cols(key)
    if definition is not None:
        rows = conform(rows, definition)
    if assign is None:
        open_ = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        taken = state.select(*key).join(rows.select(*key).distinct(), key, "left_semi")
        first = rows.where(~open_).groupBy(*key).agg(F.min(F.struct(*rows.columns)).alias("_r")).select("_r.*")
        fresh = first.join(taken, key, "left_anti").select(*rows.columns).unionByName(rows.where(open_))
        changes = fresh.select(F.lit("I").alias("op"), _null_of(fresh).alias("old"), row(fresh).alias("new"))
        return Outcome(state.unionByName(fresh), changes)
    if remote:
        raise ValueError("a remote table takes no ON CONFLICT DO UPDATE")
    if not rows.dropna(subset=key).groupBy(*key).count().where("count > 1").isEmpty():
        raise CardinalityViolation("the rows hold a key twice")
    values = {c: F.col(f"s.{c}") for c in rows.columns}
    return merge(state, rows, {k: k for k in key}, [matched_update(assign), unmatched_insert(values)], definition)


# -- archive jobs -------------------------------------------------------

class Archive(NamedTuple):
    parents: DataFrame
    children: DataFrame
    archived_parents: DataFrame
    archived_children: DataFrame


def archive(
    parents: DataFrame,
    children: DataFrame,
    key: str,
    marked: Column,
    archived_on: Column,
    stamp: str = "archived_ts",
    child_key: str | None = None,
) -> Archive:
    """Move marked parents and their children to the archive, as one change."""
    child_key = child_key or key
    ids = parents.where(marked).select(F.col(key).alias(child_key))
    return Archive(
        parents.where(~is_true(marked)),
        spread_join(children, ids, child_key, "left_anti"),
        parents.where(marked).withColumn(stamp, archived_on),
        spread_join(children, ids, child_key, "left_semi"),
    )


def archive_rounds(
    parents: DataFrame, children: DataFrame, key: str, marked: Column, size: int, child_key: str | None = None
) -> DataFrame:
    """The rounds of an archive job that takes ``size`` parents at a time.

    One row per round with the parents and children it moves, and a last round
    that finds nothing. The rounds are numbered in one pass over the sorted
    keys; the loop of the caller may run them one by one.
    """
    child_key = child_key or key
    rounds = batches(parents.where(marked).select(F.col(key).alias(child_key)), [child_key], size, "round")
    per_parent = children.groupBy(child_key).agg(F.count("*").alias("_n"))
    counted = (
        rounds.join(per_parent, child_key, "left")
        .groupBy("round")
        .agg(F.count("*").alias("parents"), F.coalesce(F.sum("_n"), F.lit(0)).alias("children"))
    )
    last = counted.agg(
        (F.coalesce(F.max("round"), F.lit(0)) + 1).alias("round"),
        F.lit(0).cast("bigint").alias("parents"),
        F.lit(0).cast("bigint").alias("children"),
    )
    return counted.unionByName(last)


# -- numbers and structure ----------------------------------------------

def assign_serial(rows: DataFrame, serial: Serial, order: Sequence[str]) -> tuple[DataFrame, Serial]:
    """Give new rows the next sequence values, in a total order.

    Returns the rows and the sequence state to keep, also if the rows are never
    committed: gaps are allowed, repeats are not.
    """
    numbered = number_rows(rows, order, "_n")
    used = numbered.agg(F.max("_n")).first()[0] or 0
    value = (F.lit(serial.last) + F.col("_n") * serial.step).alias(serial.column)
    out = numbered.select(value, *[c for c in rows.columns if c != serial.column])
    return out, replace(serial, last=serial.last + used * serial.step)


def add_column(state: DataFrame, name: str, type_name: str, default: str = "null") -> DataFrame:
    return state.withColumn(name, F.expr(default).cast(type_name))


def rename_column(state: DataFrame, old: str, new: str) -> DataFrame:
    if old not in state.columns:
        raise KeyError(old)
    return state.withColumnRenamed(old, new)


def update_through_view(
    base: DataFrame, columns: Mapping[str, str], view_filter: Column | None, assign: Mapping[str, Column], where: Column
) -> Outcome:
    """Update the base table of a one-table view.

    ``columns`` maps view names to base names; the expressions and the filter of
    the view use view names. Only rows that the view shows can change.
    """
    there = {b: v for v, b in columns.items()}
    seen = base.withColumnsRenamed(there)
    out = update(seen, assign, where if view_filter is None else where & view_filter)
    state = out.state.withColumnsRenamed(dict(columns))

    def back(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{there.get(c, c)}").alias(c) for c in base.columns])

    changes = out.changes.select("op", back("old").alias("old"), back("new").alias("new"))
    return Outcome(state, changes)


def delete_through_view(base: DataFrame, columns: Mapping[str, str], view_filter: Column | None, where: Column) -> Outcome:
    """Delete base rows through a one-table view."""
    there = {b: v for v, b in columns.items()}
    seen = base.withColumnsRenamed(there)
    out = delete(seen, where if view_filter is None else where & view_filter)
    old = F.struct(*[F.col(f"old.{there.get(c, c)}").alias(c) for c in base.columns])
    changes = out.changes.select("op", old.alias("old"), F.when(F.lit(False), old).alias("new"))
    return Outcome(out.state.withColumnsRenamed(dict(columns)), changes)

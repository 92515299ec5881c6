"""Change logs as frames: publish, apply, compare, recover.

A change row is ``lsn, timeline, commit_ts, tx, table, op, old, new, origin``;
``lsn`` orders the changes of a table, ``old`` and ``new`` are row structs. Only
the columns an operator needs have to be there. The stream jobs call these same
functions on each batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablewright.operators.recursion import components
from tablewright.operators.relational import is_true
from tablewright.operators.scale import cols, hot_keys, previous_value, spread_join
from tablewright.session import materialize
from tablewright.sources.versions import Version, differing

ALL_OPS = ("I", "U", "D", "T")
Predicate = Callable[[Column], Column]


# -- publications -----------------------------------------------------------

@dataclass(frozen=True)
class Publication:
    """Tables with an optional row filter and column list, and operations.

    A filter takes a row struct: ``lambda r: r["id"] > 2``.
    """

    name: str
    tables: Mapping[str, Predicate | None]
    ops: tuple[str, ...] = ALL_OPS
    columns: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def add_table(self, table: str, where: Predicate | None = None, columns: Sequence[str] | None = None) -> Publication:
        listed = dict(self.columns) | ({table: tuple(columns)} if columns else {})
        return Publication(self.name, dict(self.tables) | {table: where}, self.ops, listed)

    def drop_table(self, table: str) -> Publication:
        return Publication(
            self.name,
            {t: p for t, p in self.tables.items() if t != table},
            self.ops,
            {t: c for t, c in self.columns.items() if t != table},
        )


def row_filter(changes: DataFrame, where: Predicate) -> DataFrame:
    """Publish the changes of rows that satisfy a filter.

    An update into the filter becomes an insert, one out of it a delete.
    Truncates pass.
    """
    had_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    # A filter may be true of a row of nulls, but not of a missing row.
    was, now = had_old & is_true(where(F.col("old"))), has_new & is_true(where(F.col("new")))
    op = (
        F.when(F.col("op") == "T", F.lit("T"))
        .when((F.col("op") == "I") & now, F.lit("I"))
        .when((F.col("op") == "D") & was, F.lit("D"))
        # Without an old image the old row is known to satisfy nothing else.
        .when((F.col("op") == "U") & ~had_old & now, F.lit("U"))
        .when((F.col("op") == "U") & was & now, F.lit("U"))
        .when((F.col("op") == "U") & was, F.lit("D"))
        .when((F.col("op") == "U") & now, F.lit("I"))
    )
    types = {f.name: f.dataType for f in changes.schema}
    return (
        changes.withColumn("_op", op)
        .where(F.col("_op").isNotNull())
        .withColumns(
            {
                "old": F.when(F.col("_op") != "I", F.col("old")).cast(types["old"]),
                "new": F.when(F.col("_op") != "D", F.col("new")).cast(types["new"]),
                "op": F.col("_op"),
            }
        )
        .drop("_op")
    )


def column_list(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep some columns of the row images."""

    def cut(side: str) -> Column:
        return F.when(F.col(side).isNotNull(), F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns])).alias(side)

    return changes.withColumns({"old": cut("old"), "new": cut("new")})


def publish(changes: DataFrame, publications: Sequence[Publication], table: str) -> DataFrame:
    """Changes of one table as a subscriber of several publications sees them.

    A row passes if the filter of any publication that publishes the operation
    accepts it. The columns are those listed by any of them; one without a list
    means all columns, also new ones.
    """
    mine = [p for p in publications if table in p.tables]
    rows = changes.where(F.col("table") == table) if "table" in changes.columns else changes
    if not mine:
        return rows.limit(0)
    rows = rows.where(F.col("op").isin([o for o in ALL_OPS if any(o in p.ops for p in mine)]))

    def accepts(r: Column) -> Column:
        """Whether any publication of the row's operation accepts it, in one pass over the log."""
        out = F
        for op in ALL_OPS:
            filters = [p.tables[table] for p in mine if op in p.ops]
            free = not filters or any(f is None for f in filters)
            one = F.lit(bool(filters)) if free else reduce(lambda a, b: a | b, [is_true(f(r)) for f in filters])
            out = out.when(F.col("op") == op, one)
        return out

    out = rows if all(p.tables[table] is None for p in mine) else row_filter(rows, accepts)
    lists = [p.columns.get(table) for p in mine]
    if all(lists):
        out = column_list(out, list(dict.fromkeys(c for cs in lists for c in cs)))
    return out


def check_overlap(subscriptions: Mapping[str, Sequence[Publication]]) -> None:
    """Refuse two subscriptions of one pair of servers that share a table."""
    seen: dict[str, str] = {}
    for name, publications in subscriptions.items():
        for table in {t for p in publications for t in p.tables}:
            if seen.setdefault(table, name) != name:
                raise ValueError(f"{table} is in subscriptions {seen[table]} and {name}")


def local_only(changes: DataFrame) -> DataFrame:
    """Changes made here, not replayed from elsewhere: ends two-way loops."""
    return changes.where(F.col("origin").isNull())


def republish(applied: DataFrame, origin: str) -> DataFrame:
    """Applied changes as the log of a server further down the cascade."""
    return applied.withColumn("origin", F.coalesce(F.col("origin"), F.lit(origin)))


def schema_drift(changes: DataFrame, target: StructType) -> list[str]:
    """Published columns that the target lacks or has with another type."""
    have = {f.name: f.dataType for f in target}
    sent = changes.schema["new"].dataType
    return [f.name for f in sent if f.name not in have or have[f.name] != f.dataType]


class SchemaDrift(ValueError):
    """The source has columns the target cannot take; the stream stops."""


def check_drift(changes: DataFrame, target: StructType) -> None:
    drifted = schema_drift(changes, target)
    if drifted:
        raise SchemaDrift(f"the target cannot take {drifted}")


# -- apply ------------------------------------------------------------------

def split_key_changes(changes: DataFrame, key: str | Sequence[str], order: str = "lsn") -> DataFrame:
    """Replay an update of the key as delete of the old and insert of the new.

    Adds ``_seq``, the place within one change.
    """
    key = cols(key)
    moved = reduce(
        lambda a, b: a | b, [~F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key]
    ) & F.col("old").isNotNull() & F.col("new").isNotNull() & (F.col("op") == "U")
    rest = [c for c in changes.columns if c not in ("op", "old", "new")]
    types = {f.name: f.dataType for f in changes.schema}

    def step(seq: int, op: Column, old: Column, new: Column) -> Column:
        return F.struct(F.lit(seq).alias("_seq"), op.alias("op"), old.alias("old"), new.alias("new"))

    none_new, none_old = F.lit(None).cast(types["new"]), F.lit(None).cast(types["old"])
    halves = F.array(
        step(0, F.lit("D"), F.col("old"), none_new), step(1, F.lit("I"), none_old, F.col("new"))
    )
    whole = F.array(step(0, F.col("op"), F.col("old"), F.col("new")))
    return changes.select(*rest, F.explode(F.when(moved, halves).otherwise(whole)).alias("_c")).select(*rest, "_c.*")


def key_of(key: Sequence[str]) -> list[Column]:
    """Key of a change: of the new row, or the old one of a delete."""
    return [
        F.when(F.col("op") == "D", F.col(f"old.{k}")).otherwise(F.coalesce(F.col(f"new.{k}"), F.col(f"old.{k}"))).alias(k)
        for k in key
    ]


def net_changes(changes: DataFrame, key: str | Sequence[str], order: str = "lsn") -> DataFrame:
    """Last change per key: ``key.., op, new, made``.

    ``made`` is the last insert or delete of the key in the log, null if it was
    only updated. One aggregation with partial results per task, so a key with
    very many changes costs one row per task.
    """
    key = cols(key)
    steps = split_key_changes(changes.where(F.col("op") != "T"), key, order)
    at = F.struct(F.col(order), F.col("_seq"))
    born = F.col("op").isin("I", "D")
    rows = steps.select(
        *key_of(key),
        F.struct(at.alias("at"), F.col("op").alias("op"), F.col("new").alias("new")).alias("_c"),
        F.when(born, F.struct(at.alias("at"), F.col("op").alias("op"))).alias("_b"),
    )
    out = rows.groupBy(*key).agg(
        F.max_by("_c", F.col("_c.at")).alias("_c"), F.max("_b").alias("_b")
    )
    return out.select(*key, F.col("_c.op").alias("op"), F.col("_c.new").alias("new"), F.col("_b.op").alias("made"))


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    order: str = "lsn",
    defaults: Mapping[str, Column] | None = None,
    truncates: bool = True,
) -> DataFrame:
    """The table after a change log, as row-by-row replay would leave it.

    Columns match by name. Columns of the table that the log lacks keep their
    value in updates and take ``defaults`` in inserts. Updates and deletes of
    missing rows are skipped. The table is only joined to the net change per
    key: if Spark can broadcast that, the table is not shuffled. Keys that an
    update moves depend on each other; they are replayed row by row, each set of
    keys that moves connect by itself.
    """
    key = cols(key)
    defaults = defaults or {}
    sent = [f.name for f in changes.schema["new"].dataType if f.name in base.columns]
    extra = [c for c in base.columns if c not in sent]
    if truncates:
        # Uncorrelated scalar subquery: position of the last truncate, if any.
        cut = changes.where("op = 'T'").agg(F.max(order)).scalar()
        base = base.where(cut.isNull())
        changes = changes.where(cut.isNull() | (F.col(order) > cut))
    moved = changes.where(_moves(key)).select(_key_hash(key, "old").alias("a"), _key_hash(key, "new").alias("b"))
    moved = materialize(moved, "moves")
    replayed = None
    if not moved.isEmpty():
        replayed, base, changes = _replayed(base, changes, key, order, defaults, sent, components(moved))
    net = materialize(net_changes(changes, key, order), "net")
    untouched = base.join(net.select(*key), key, "left_anti").select(*base.columns)
    types = {f.name: f.dataType for f in base.schema}

    born = net.where("op != 'D' and made = 'I'").select(
        *[
            (F.col(f"new.{c}") if c in sent else defaults.get(c, F.lit(None))).cast(types[c]).alias(c)
            for c in base.columns
        ]
    )
    # Rows that were only updated must exist already, and keep other columns.
    grown = net.where("op = 'U' and made is null").select(*key, F.col("new").alias("_new"))
    kept = base.select(*dict.fromkeys([*key, *extra]))
    updated = kept.join(grown, key).select(
        *[
            (F.col(c) if c in extra or c in key else F.col(f"_new.{c}").cast(types[c])).alias(c)
            for c in base.columns
        ]
    )
    out = untouched.unionByName(updated).unionByName(born)
    return out if replayed is None else out.unionByName(replayed)


def _moves(key: Sequence[str]) -> Column:
    """Whether a change is an update that changes the key."""
    other = reduce(lambda a, b: a | b, [~F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key])
    return (F.col("op") == "U") & F.col("old").isNotNull() & F.col("new").isNotNull() & other


def _key_hash(key: Sequence[str], side: str | None = None) -> Column:
    return F.xxhash64(*[F.col(f"{side}.{k}" if side else k) for k in key])


def _replayed(
    base: DataFrame,
    changes: DataFrame,
    key: list[str],
    order: str,
    defaults: Mapping[str, Column],
    sent: list[str],
    roots: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows that the connected keys end with, and the table and the log of the other keys.

    A task holds the present rows of one set of connected keys at a time.
    """
    types = {f.name: f.dataType for f in base.schema}
    empty = F.struct(*[(defaults.get(c, F.lit(None))).cast(types[c]).alias(c) for c in base.columns])
    held = F.struct(*[F.col(c) for c in base.columns])

    def image(side: str) -> Column:
        cut = F.struct(*[(F.col(f"{side}.{c}") if c in sent else F.lit(None)).cast(types[c]).alias(c) for c in base.columns])
        return F.when(F.col(side).isNotNull(), cut)

    at_key = F.xxhash64(*[F.when(F.col("op") == "I", F.col(f"new.{k}")).otherwise(F.coalesce(F.col(f"old.{k}"), F.col(f"new.{k}"))) for k in key])
    log = changes.where("op != 'T'").withColumn("node", at_key).join(roots, "node", "left")
    rows = base.withColumn("node", _key_hash(key)).join(roots, "node", "left")
    own = rows.where("root is not null").select("root", F.lit(None).cast("bigint").alias("pos"), F.lit("B").alias("op"), F.when(F.lit(False), held).alias("old"), held.alias("new"), empty.alias("empty"))
    steps = log.where("root is not null").select("root", F.col(order).cast("bigint").alias("pos"), "op", image("old").alias("old"), image("new").alias("new"), empty.alias("empty"))
    both = own.unionByName(steps).repartition("root").sortWithinPartitions("root", F.asc_nulls_first("pos"))
    target = to_arrow_schema(base.schema)

    def task(batches):
        now, root = {}, None

        def name(row: dict) -> tuple:
            return tuple(row[k] for k in key)

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["root"] != root:
                    out += now.values()
                    now, root = {}, r["root"]
                old, new = r["old"], r["new"]
                if r["op"] == "B":
                    now[name(new)] = new
                elif r["op"] == "I":
                    now[name(new)] = {**r["empty"], **{c: new[c] for c in sent}}
                elif r["op"] == "D":
                    now.pop(name(old), None)
                elif name(old or new) in now:
                    row = {**now.pop(name(old or new)), **{c: new[c] for c in sent}}
                    now[name(row)] = row
            yield from pa.Table.from_pylist(out, schema=target).to_batches()
        yield from pa.Table.from_pylist(list(now.values()), schema=target).to_batches()

    return both.mapInArrow(task, base.schema), rows.where("root is null").select(*base.columns), log.where("root is null").select(*changes.columns)


def diff(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Changes that lead from one version of a table to another.

    Keys are unique on both sides, so the full outer join has no hot key.
    Unchanged rows are dropped right after it.
    """
    key = cols(key)
    o = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.struct(*before.columns).alias("old"))
    n = after.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], F.struct(*before.columns).alias("new"))
    both = o.join(n, [f"_k{i}" for i in range(len(key))], "full_outer")
    op = F.when(F.col("old").isNull(), "I").when(F.col("new").isNull(), "D").otherwise("U")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(op.alias("op"), "old", "new")


def diff_versions(before: Version, after: Version) -> DataFrame:
    """The same for stored versions: only ranges of keys whose digests differ are read and joined."""
    ranges = differing(before, after)
    return diff(before.within(ranges), after.within(ranges), before.key)


def initial_copy(source: DataFrame, where: Predicate | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows a new subscriber starts with: filtered rows, listed columns."""
    # A field of a struct of plain columns is that column to the optimizer, so the filter reaches the scan.
    out = source if where is None else source.where(where(F.struct(*source.columns)))
    return out.select(*columns) if columns else out


def follow(changes: DataFrame, after: int, order: str = "lsn") -> DataFrame:
    """Changes after the position of the initial copy."""
    return changes.where(F.col(order) > F.lit(after))


# -- conflicts ----------------------------------------------------------------

# The names of the conflict classes.
STOPPING = ("insert_exists", "update_exists", "multiple_unique_conflicts")
SKIPPED = ("update_missing", "delete_missing")
APPLIED = ("update_origin_differs", "delete_origin_differs")


def conflicts(
    base: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    order: str = "lsn",
    base_origin: str | None = None,
    uniques: Sequence[Sequence[str]] = (),
    hot: Mapping[int, int] | None = None,
) -> DataFrame:
    """Class of each change that meets a conflict in the target, else null.

    Each change is judged as replay would meet it: whether its key exists is
    what the last insert or delete of the key before it says, else the table.
    ``order`` must be a number. ``base_origin`` names the column of the table
    with the origin of a row's last writer; ``uniques`` lists further unique
    keys of the table, which need old images in the log.
    """
    key = cols(key)
    log = changes.where(F.col("op") != "T")
    moves = materialize(log.where(_moves(key)).select(order), "moves")
    lost = None
    if not moves.isEmpty():
        # A move of a missing row makes no row; without it later moves may miss theirs.
        while True:
            rest = log if lost is None else log.join(lost, order, "left_anti")
            found = _classified(base, rest, key, order, base_origin, uniques, hot)
            gone = materialize(found.where("conflict = 'delete_missing' and _moved").select(order).distinct(), "lost")
            if gone.isEmpty():
                break
            lost = gone if lost is None else materialize(lost.union(gone), "lost")
    rest = log if lost is None else log.join(lost, order, "left_anti")
    out = _classified(base, rest, key, order, base_origin, uniques, hot).drop("_moved")
    if lost is None:
        return out
    skipped = log.join(lost, order, "left_semi").select(*changes.columns, *[F.col(f"old.{k}").alias(f"key_{k}") for k in key], F.lit("update_missing").alias("conflict"))
    return out.unionByName(skipped)


def _classified(base, changes, key, order, base_origin, uniques, hot) -> DataFrame:
    steps = split_key_changes(changes.withColumn("_moved", _moves(key)), key, order)
    has_origin = "origin" in steps.columns
    origin = F.col("origin") if has_origin else F.lit(None).cast("string")
    steps = steps.withColumn("_pos", F.col(order) * 2 + F.col("_seq")).withColumns(
        {f"_k{i}": k for i, k in enumerate(key_of(key))}
    )
    names = [f"_k{i}" for i in range(len(key))]
    hot = hot_keys(steps, names) if hot is None else hot
    born = F.col("op").isin("I", "D")
    steps = previous_value(steps, names, "_pos", F.col("op"), "_last_born", when=born, hot=hot)
    if has_origin:
        steps = previous_value(
            steps, names, "_pos", F.struct(origin.alias("o")), "_writer", when=F.col("op") != "D", hot=hot
        )
    else:
        steps = steps.withColumn("_writer", F.struct(origin.alias("o")))
    known = base.select(
        *[F.col(k).alias(n) for k, n in zip(key, names)],
        F.lit(True).alias("_there"),
        (F.col(base_origin) if base_origin else F.lit(None)).cast("string").alias("_base_origin"),
    )
    # The table has each key once; the log may have one key very often.
    steps = spread_join(steps, known, names, "left", hot=hot)
    exists = F.when(F.col("_last_born").isNull(), F.coalesce(F.col("_there"), F.lit(False))).otherwise(
        F.col("_last_born") == "I"
    )
    writer = F.when(F.col("_writer").isNotNull(), F.col("_writer.o")).otherwise(F.col("_base_origin"))
    differs = ~writer.eqNullSafe(origin) if has_origin else F.lit(False)

    from_update = F.col("_seq") == 1
    clashes = (F.col("op") == "I") & exists
    hits = clashes.cast("int")
    steps = steps.withColumns({"_exists": exists, "_differs": differs, "_hits": hits})
    for i, unique in enumerate(uniques):
        taken = _unique_clashes(base, changes, key, list(unique), order).select(
            F.col(order).alias(f"_u{i}"), F.lit(1).alias(f"_hit{i}")
        )
        steps = steps.join(taken, steps[order] == taken[f"_u{i}"], "left")
        steps = steps.withColumn(
            "_hits",
            F.col("_hits") + F.when(F.col("op").isin("I", "U"), F.coalesce(F.col(f"_hit{i}"), F.lit(0))).otherwise(0),
        ).drop(f"_u{i}", f"_hit{i}")
    single = F.when(from_update | (F.col("op") == "U"), "update_exists").otherwise("insert_exists")
    kind = (
        F.when(F.col("_hits") > 1, "multiple_unique_conflicts")
        .when(F.col("_hits") == 1, single)
        .when((F.col("op") == "U") & ~F.col("_exists"), "update_missing")
        .when((F.col("op") == "D") & ~F.col("_exists") & (F.col("_seq") == 0), F.when(F.col("new").isNull(), "delete_missing"))
        .when((F.col("op") == "U") & F.col("_differs"), "update_origin_differs")
        .when((F.col("op") == "D") & F.col("_differs"), "delete_origin_differs")
    )
    return steps.select(*changes.columns, *[F.col(n).alias(f"key_{k}") for n, k in zip(names, key)], kind.alias("conflict"), "_moved")


def _unique_clashes(base: DataFrame, changes: DataFrame, key: list[str], unique: list[str], order: str) -> DataFrame:
    """Positions of changes that write a unique value another row holds.

    Each value has a history of rows that take and release it; the value is
    taken if the event before says so, or else if a row of the table has it.
    """
    log = changes.where(F.col("op") != "T")

    def value(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in unique])

    def owner(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{k}").alias(k) for k in key])

    complete = reduce(lambda a, b: a & b, [F.col(f"_v.{c}").isNotNull() for c in unique])
    changed = F.col("old").isNull() | ~value("old").eqNullSafe(value("new"))
    events = F.array(
        F.when(
            F.col("old").isNotNull() & ((F.col("op") == "D") | changed),
            F.struct(value("old").alias("_v"), F.lit(0).alias("_take"), owner("old").alias("_owner")),
        ),
        F.when(
            F.col("new").isNotNull() & ((F.col("op") == "I") | ((F.col("op") == "U") & changed)),
            F.struct(value("new").alias("_v"), F.lit(1).alias("_take"), owner("new").alias("_owner")),
        ),
    )
    rows = (
        log.select(F.col(order), F.explode(F.array_compact(events)).alias("_e"))
        .select(order, "_e.*")
        .where(complete)
        .withColumn("_pos", F.col(order) * 2 + F.col("_take"))
    )
    seen = previous_value(rows, "_v", "_pos", F.struct("_take", "_owner"), "_before")
    holder = base.dropna(subset=unique).select(
        F.struct(*unique).alias("_v"), F.struct(*key).alias("_holder")
    )
    joined = spread_join(seen.where("_take = 1"), holder, "_v", "left")
    by_log = (F.col("_before._take") == 1) & ~F.col("_before._owner").eqNullSafe(F.col("_owner"))
    by_base = F.col("_holder").isNotNull() & ~F.col("_holder").eqNullSafe(F.col("_owner"))
    return joined.where(F.when(F.col("_before").isNotNull(), by_log).otherwise(by_base)).select(order).distinct()


def conflict_counts(classified: DataFrame, subscription: str) -> DataFrame:
    """Conflicts per class, as a subscription's statistics."""
    return classified.where(F.col("conflict").isNotNull()).groupBy(
        F.lit(subscription).alias("subscription"), "conflict"
    ).agg(F.count("*").alias("n"))


def truncate_blocked(truncated: Sequence[str], references: Mapping[str, Sequence[str]]) -> list[str]:
    """Tables outside the set that reference one inside: the truncate fails."""
    return sorted(t for t, refs in references.items() if t not in truncated and set(refs) & set(truncated))


# -- recovery -----------------------------------------------------------------

def until(
    changes: DataFrame,
    commit_ts=None,
    lsn: int | None = None,
    tx: int | None = None,
    name: str | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Changes up to a recovery target: time, position, transaction or name.

    A named target is a log row with op ``R`` and that name in ``table``. A
    transaction or name that the log does not have is an error.
    """
    targets = [t for t in (commit_ts, lsn, tx, name) if t is not None]
    if len(targets) != 1:
        raise ValueError("give one recovery target")

    def cut(column: Column, value: Column) -> Column:
        return column <= value if inclusive else column < value

    if commit_ts is not None:
        stop = cut(F.col("commit_ts"), F.lit(commit_ts).cast(changes.schema["commit_ts"].dataType))
    elif lsn is not None:
        stop = cut(F.col("lsn"), F.lit(lsn))
    elif tx is not None:
        # Transactions count in commit order: that of their last change.
        found = changes.where(F.col("tx") == tx)
        end = _known(F.max("lsn") if inclusive else F.min("lsn"), f"no transaction {tx} in the log")
        stop = cut(F.col("lsn"), found.agg(end).scalar())
    else:
        found = changes.where((F.col("op") == "R") & (F.col("table") == name))
        stop = F.col("lsn") <= found.agg(_known(F.max("lsn"), f"no target {name} in the log")).scalar()
    return changes.where(stop & (F.col("op") != "R"))


def _known(position: Column, message: str) -> Column:
    return F.coalesce(position, F.raise_error(F.lit(message)).cast("bigint"))


def recover(base: DataFrame, changes: DataFrame, key: str | Sequence[str], **target) -> DataFrame:
    """The table at a recovery target: base copy plus the log up to it."""
    return apply_changes(base, until(changes, **target), key)


def delayed(changes: DataFrame, now: Column, delay: str) -> DataFrame:
    """Changes old enough for a replica that stays behind by ``delay``."""
    return changes.where(F.col("commit_ts") <= now - F.expr(f"INTERVAL {delay}"))

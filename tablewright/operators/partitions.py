"""Partitioned and inherited tables: routing, pruning, moving of parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.rules import RuleViolation
from tablewright.plans.tabledef import Part, PartitionSpec, TableDef

PART = "_part"


# -- specs --------------------------------------------------------------

def by_range(column: str | Sequence[str], parts: Mapping[str, tuple], default: str | None = None) -> PartitionSpec:
    """``{"p100": (0, 100)}``: bounds are ``[low, high)``; tuples for several columns."""
    columns = (column,) if isinstance(column, str) else tuple(column)

    def bound(v):
        return None if v is None else tuple(v) if isinstance(v, (tuple, list)) else (v,)

    made = [Part(n, low=bound(lo), high=bound(hi)) for n, (lo, hi) in parts.items()]
    if default:
        made.append(Part(default, default=True))
    spec = PartitionSpec("range", columns, tuple(made))
    check_spec(spec)
    return spec


def by_list(column: str, parts: Mapping[str, Sequence], default: str | None = None) -> PartitionSpec:
    made = [Part(n, values=tuple(v)) for n, v in parts.items()]
    if default:
        made.append(Part(default, default=True))
    spec = PartitionSpec("list", (column,), tuple(made))
    check_spec(spec)
    return spec


def by_hash(column: str, modulus: int, text: bool = False, prefix: str = "p") -> PartitionSpec:
    """Remainders 0 .. modulus-1. Text keys go through a prefix of their md5."""
    made = tuple(Part(f"{prefix}{r}", remainder=r) for r in range(modulus))
    return PartitionSpec("hash", (column,), made, modulus, text)


def _sorted_ranges(spec: PartitionSpec) -> list[Part]:
    ranges = [p for p in spec.parts if not p.default]
    return sorted(ranges, key=lambda p: (p.low is not None, p.low or ()))


def check_spec(spec: PartitionSpec) -> None:
    """Refuse overlaps, empty ranges, repeated values, names or remainders."""
    names = [p.name for p in spec.parts]
    if len(set(names)) != len(names):
        raise ValueError("partition names repeat")
    if sum(p.default for p in spec.parts) > 1:
        raise ValueError("more than one default partition")
    if spec.kind == "range":
        for p in _sorted_ranges(spec):
            if p.low is not None and p.high is not None and p.low >= p.high:
                raise ValueError(f"empty range {p.name}")
        for a, b in pairwise(_sorted_ranges(spec)):
            if a.high is None or b.low is None or b.low < a.high:
                raise ValueError(f"partitions {a.name} and {b.name} overlap")
    elif spec.kind == "list":
        seen = [v for p in spec.parts for v in (p.values or ())]
        if len(set(seen)) != len(seen):
            raise ValueError("a list value is in two partitions")
    else:
        seen = [p.remainder for p in spec.parts]
        if len(set(seen)) != len(seen):
            raise ValueError("a remainder is in two partitions")


def inside(child: PartitionSpec, parent: Part) -> bool:
    """Whether the bounds of sub-partitions lie in their parent's."""
    for p in child.parts:
        if p.default or child.kind == "hash":
            continue
        if child.kind == "list":
            if parent.values is not None and not set(p.values) <= set(parent.values):
                return False
        elif parent.low is not None and (p.low is None or p.low < parent.low):
            return False
        elif parent.high is not None and (p.high is None or p.high > parent.high):
            return False
    return True


# -- routing ------------------------------------------------------------

def hash_slot(key: Column, modulus: int, text: bool = False) -> Column:
    """The remainder of a key; integers by value, text by md5."""
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") if text else key
    return F.pmod(number, F.lit(modulus))


def part_of(spec: PartitionSpec) -> Column:
    """The partition name of a row, or null when none takes it.

    Range routing is a balanced CASE tree over the sorted bounds: the cost per
    row grows with the logarithm of the number of partitions.
    """
    fallback = next((p.name for p in spec.parts if p.default), None)
    default = F.lit(fallback).cast("string")
    if spec.kind == "hash":
        # A null key hashes like zero, so it has a place.
        slot = F.coalesce(hash_slot(F.col(spec.columns[0]), spec.modulus, spec.text_key), F.lit(0))
        names = {p.remainder: p.name for p in spec.parts}
        named = F.array(*[F.lit(names.get(r, fallback)).cast("string") for r in range(spec.modulus)])
        return F.get(named, slot.cast("int"))
    if spec.kind == "list":
        key, out = F.col(spec.columns[0]), F
        for p in spec.parts:
            if p.values is not None:
                real = [v for v in p.values if v is not None]
                hit = key.isin(real) if real else F.lit(False)
                out = out.when(hit | key.isNull() if None in p.values else hit, F.lit(p.name))
        return out.otherwise(default) if out is not F else default

    ranges = _sorted_ranges(spec)
    cuts, leaves = [], [None]
    for p in ranges:
        if p.low is None:
            leaves[-1] = p.name
        elif cuts and cuts[-1] == p.low:
            leaves[-1] = p.name
        else:
            cuts.append(p.low)
            leaves.append(p.name)
        if p.high is not None:
            cuts.append(p.high)
            leaves.append(None)
    single = len(spec.columns) == 1
    key = F.col(spec.columns[0]) if single else F.struct(*spec.columns)

    def literal(bound: tuple) -> Column:
        return F.lit(bound[0]) if single else F.struct(*[F.lit(v).alias(c) for v, c in zip(bound, spec.columns)])

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return default if leaves[lo] is None else F.lit(leaves[lo])
        mid = (lo + hi) // 2
        return F.when(key < literal(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.columns])
    return F.when(unknown, default).otherwise(tree(0, len(cuts)))


def route(df: DataFrame, spec: PartitionSpec, name: str = PART) -> DataFrame:
    return df.withColumn(name, part_of(spec))


def unroutable(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    return df.where(part_of(spec).isNull())


def route_checked(df: DataFrame, spec: PartitionSpec, name: str = PART) -> DataFrame:
    """Route, failing the whole job on the first row that fits nowhere."""
    target = part_of(spec)
    keys = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in spec.columns])
    return df.withColumn(
        name,
        F.when(target.isNull(), F.raise_error(F.concat(F.lit("no partition for "), keys)).cast("string")).otherwise(target),
    )


def route_sub(df: DataFrame, spec: PartitionSpec, subs: Mapping[str, PartitionSpec], name: str = PART) -> DataFrame:
    """Two levels: ``name`` and ``name_sub``; a part without subs has a null."""
    for part, sub in subs.items():
        if not inside(sub, spec.part(part)):
            raise ValueError(f"sub-partitions of {part} leave its bounds")
    out = F
    for part, sub in subs.items():
        out = out.when(F.col(name) == part, part_of(sub))
    return route(df, spec, name).withColumn(f"{name}_sub", out.otherwise(F.lit(None).cast("string")))


# -- reading ------------------------------------------------------------

def parts_between(spec: PartitionSpec, low=None, high=None, closed: bool = True) -> list[str]:
    """Names of the partitions that can hold keys from ``low`` to ``high``."""
    if spec.kind != "range" or len(spec.columns) != 1:
        raise ValueError("needs a range over one column")
    names = []
    for p in spec.parts:
        if not p.default:
            if low is not None and p.high is not None and p.high[0] <= low:
                continue
            if high is not None and p.low is not None and (p.low[0] > high or (not closed and p.low[0] == high)):
                continue
        names.append(p.name)
    return names


def parts_for(spec: PartitionSpec, values: Sequence) -> list[str]:
    """Names of the partitions that can hold one of the key values."""
    if spec.kind == "hash":
        if spec.text_key:
            raise ValueError("text hashes are computed by Spark; filter by hash_slot")
        slots = {v % spec.modulus for v in values}
        return [p.name for p in spec.parts if p.remainder in slots]
    if spec.kind == "list":
        hit = [p.name for p in spec.parts if p.values is not None and set(values) & set(p.values)]
        known = {v for p in spec.parts for v in (p.values or ())}
        return hit + [p.name for p in spec.parts if p.default and set(values) - known]
    return [n for n in (p.name for p in spec.parts) if any(n in parts_between(spec, v, v) for v in values)]


def pruned(df: DataFrame, spec: PartitionSpec, low=None, high=None, closed: bool = True, name: str = PART) -> DataFrame:
    """Filter by key range and tell Spark which partitions that leaves.

    The key predicate alone cannot prune folders named by a derived column; the
    added predicate on that column can.
    """
    key = F.col(spec.columns[0])
    out = df.where(F.col(name).isin(parts_between(spec, low, high, closed)))
    if low is not None:
        out = out.where(key >= F.lit(low))
    if high is not None:
        out = out.where(key <= F.lit(high) if closed else key < F.lit(high))
    return out


# -- splitting an existing table -----------------------------------------

def equal_ranges(df: DataFrame, column: str, step: int, prefix: str = "p", most: int = 10_000) -> PartitionSpec:
    """Ranges of equal width that cover a column, from its minimum up.

    Bounds are half open, so a value on a bound is in the upper range. A table
    of more than ``most`` partitions is refused; ``split_equal`` numbers ranges
    without making any.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return PartitionSpec("range", (column,), ())
    count = int((high - low) // step) + 1
    if count > most:
        raise ValueError(f"{count} partitions")
    return by_range(column, {f"{prefix}{i + 1}": (low + i * step, low + (i + 1) * step) for i in range(count)})


def split_equal(df: DataFrame, column: str, step: int, name: str = PART) -> DataFrame:
    """Number the equal range of each row, 1 up, in one pass after min."""
    low = df.agg(F.min(column)).first()[0]
    if low is None:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    slot = F.floor((F.col(column) - F.lit(low)) / F.lit(step)) + 1
    return df.withColumn(name, slot.cast("bigint"))


# -- inheritance ---------------------------------------------------------

def inherit_route(df: DataFrame, children: Mapping[str, str], parent: str, name: str = "_table") -> DataFrame:
    """Send each row to the first child whose CHECK is true, else the parent."""
    out = F
    for child, check in children.items():
        out = out.when(F.coalesce(F.expr(check), F.lit(False)), F.lit(child))
    return df.withColumn(name, out.otherwise(F.lit(parent)) if children else F.lit(parent))


def inherit_read(tables: Mapping[str, DataFrame], parent: str, only: bool = False, name: str = "_table") -> DataFrame:
    """The parent with its children, by the parent's columns; ONLY leaves them out."""
    own = tables[parent]
    if only:
        return own.withColumn(name, F.lit(parent))
    frames = [own.withColumn(name, F.lit(parent))]
    frames += [t.select(*own.columns).withColumn(name, F.lit(n)) for n, t in tables.items() if n != parent]
    return reduce(lambda a, b: a.unionByName(b), frames)


def merged_columns(parents: Sequence[TableDef], name: str, extra_ddl: str = "") -> TableDef:
    """Columns of a child of several parents: same names merge, types must agree."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    fields = {}
    for f in [f for p in parents for f in p.schema] + (list(_parse_datatype_string(extra_ddl)) if extra_ddl else []):
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} has two types")
        fields.setdefault(f.name, f)
    return TableDef(name, StructType(list(fields.values())), checks=tuple(c for p in parents for c in p.checks))


def read_children(tables: Mapping[str, DataFrame], checks: Mapping[str, tuple], parent: str, column: str, low=None, high=None) -> DataFrame:
    """Rows with the key in ``low..high``; children whose CHECK range rules them out are not read."""
    kept = {n: t for n, t in tables.items() if n not in checks or not can_skip(*checks[n], low, high)}
    rows = inherit_read(kept, parent)
    return rows.where(F.col(column) >= low if high is None else F.col(column) <= high if low is None else F.col(column).between(low, high))


def can_skip(check_low, check_high, low=None, high=None) -> bool:
    """Whether a child with CHECK ``[check_low, check_high)`` has no key in ``low..high``."""
    return (low is not None and check_high is not None and check_high <= low) or (
        high is not None and check_low is not None and check_low > high
    )


# -- moving parts ----------------------------------------------------------

def attach_violations(rows: DataFrame, part: Part, spec: PartitionSpec) -> DataFrame:
    """Rows that do not belong in a partition about to be attached."""
    alone = replace(spec, parts=(part,))
    return rows.where(part_of(alone).isNull())


def check_rows(rows: DataFrame, part: Part, spec: PartitionSpec) -> None:
    if not attach_violations(rows, part, spec).isEmpty():
        raise RuleViolation(f"rows outside the bounds of {part.name}")


def moved_rows(before: DataFrame, after: DataFrame, key: str, spec: PartitionSpec) -> DataFrame:
    """``key, old_part, new_part`` of the rows that an update sends to another partition."""
    old = before.select(key, part_of(spec).alias("old_part"))
    new = after.select(key, part_of(spec).alias("new_part"))
    return old.join(new, key).where(~F.col("old_part").eqNullSafe(F.col("new_part")))


def gathered(sharded: DataFrame, by: Sequence[str], aggregates: Sequence[Column], final: Sequence[Column]) -> DataFrame:
    """Scatter and gather: aggregate in each shard, then over the shards' results."""
    return sharded.groupBy("_shard", *by).agg(*aggregates).groupBy(*by).agg(*final)


def shards(df: DataFrame, key: str, count: int, text: bool = False) -> DataFrame:
    """Tag rows with the shard of their key."""
    return df.withColumn("_shard", hash_slot(F.col(key), count, text))


def attach_overlap(default_rows: DataFrame, part: Part, spec: PartitionSpec) -> DataFrame:
    """Rows of the default partition that a new partition would own."""
    alone = replace(spec, parts=(part,))
    return default_rows.where(part_of(alone).isNotNull())

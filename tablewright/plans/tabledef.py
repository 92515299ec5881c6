"""Table definitions: columns, rules, defaults, partitions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace

from pyspark.sql.types import StructField, StructType, _parse_datatype_string


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]
    name: str = ""
    primary: bool = False
    deferrable: bool = False

    @property
    def label(self) -> str:
        return self.name or ("pkey" if self.primary else "key") + "(" + ",".join(self.columns) + ")"


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...]
    name: str = ""
    deferrable: bool = False

    @property
    def label(self) -> str:
        return self.name or f"fkey({','.join(self.columns)})->{self.table}"


@dataclass(frozen=True)
class Check:
    name: str
    expression: str


@dataclass(frozen=True)
class Serial:
    """Numbering state of a column: the next value is ``last + step``."""

    column: str
    last: int = 0
    step: int = 1


@dataclass(frozen=True)
class Part:
    """One partition. Bounds are ``[low, high)``; None in a bound is open."""

    name: str
    low: tuple | None = None
    high: tuple | None = None
    values: tuple | None = None
    remainder: int | None = None
    default: bool = False


@dataclass(frozen=True)
class PartitionSpec:
    """How rows are split: kind is ``range``, ``list`` or ``hash``."""

    kind: str
    columns: tuple[str, ...]
    parts: tuple[Part, ...] = ()
    modulus: int | None = None
    text_key: bool = False

    def part(self, name: str) -> Part:
        for p in self.parts:
            if p.name == name:
                return p
        raise KeyError(f"no partition {name}")

    def with_part(self, part: Part) -> PartitionSpec:
        return replace(self, parts=(*self.parts, part))

    def without(self, name: str) -> PartitionSpec:
        self.part(name)
        return replace(self, parts=tuple(p for p in self.parts if p.name != name))


@dataclass(frozen=True)
class TableDef:
    name: str
    schema: StructType
    uniques: tuple[Unique, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)
    serial: Serial | None = None
    partition: PartitionSpec | None = None
    sort_key: tuple[str, ...] = ()
    disabled_rules: tuple[str, ...] = ()

    @property
    def key(self) -> tuple[str, ...]:
        for u in self.uniques:
            if u.primary:
                return u.columns
        return self.uniques[0].columns if self.uniques else ()

    # -- changes of the definition alone; data changes are in operators.state

    def add(self, rule: Unique | ForeignKey | Check) -> TableDef:
        kind = {Unique: "uniques", ForeignKey: "foreign_keys", Check: "checks"}[type(rule)]
        return replace(self, **{kind: (*getattr(self, kind), rule)})

    def drop_rule(self, label: str) -> TableDef:
        kept = {
            "uniques": tuple(u for u in self.uniques if u.label != label),
            "foreign_keys": tuple(f for f in self.foreign_keys if f.label != label),
            "checks": tuple(c for c in self.checks if c.name != label),
        }
        if sum(map(len, kept.values())) == len(self.uniques) + len(self.foreign_keys) + len(self.checks):
            raise KeyError(f"no rule {label} on {self.name}")
        return replace(self, **kept)

    def add_column(self, name: str, type_name: str, default: str | None = None, not_null: bool = False) -> TableDef:
        added = StructField(name, _parse_datatype_string(type_name))
        return replace(
            self,
            schema=StructType([*self.schema.fields, added]),
            defaults=self.defaults | ({name: default} if default is not None else {}),
            not_null=(*self.not_null, name) if not_null else self.not_null,
        )

    def rename_column(self, old: str, new: str) -> TableDef:
        def swap(names):
            return tuple(new if n == old else n for n in names)

        return replace(
            self,
            schema=StructType([StructField(new if f.name == old else f.name, f.dataType, f.nullable) for f in self.schema]),
            uniques=tuple(replace(u, columns=swap(u.columns)) for u in self.uniques),
            foreign_keys=tuple(replace(f, columns=swap(f.columns)) for f in self.foreign_keys),
            checks=tuple(replace(c, expression=re.sub(rf"(?<![\w`]){re.escape(old)}(?![\w`])", f"`{new}`", c.expression)) for c in self.checks),
            not_null=swap(self.not_null),
            lengths={new if k == old else k: v for k, v in self.lengths.items()},
            defaults={new if k == old else k: v for k, v in self.defaults.items()},
            sort_key=swap(self.sort_key),
            partition=replace(self.partition, columns=swap(self.partition.columns)) if self.partition else None,
            serial=replace(self.serial, column=swap((self.serial.column,))[0]) if self.serial else None,
        )

    def enable(self, *rules: str) -> TableDef:
        return replace(self, disabled_rules=tuple(r for r in self.disabled_rules if rules and r not in rules))

    def disable(self, *rules: str) -> TableDef:
        return replace(self, disabled_rules=tuple(dict.fromkeys((*self.disabled_rules, *rules))))


def table(name: str, ddl: str, **rules) -> TableDef:
    """Shorthand: ``table("t", "id int, name string", uniques=(...))``."""
    return TableDef(name, _parse_datatype_string(ddl), **rules)

"""Row policies: which rows of a table a role may see."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """``predicate`` gets the role that reads; ``roles`` may name groups."""

    name: str
    roles: tuple[str, ...]
    predicate: Callable[[str], Column]


def groups_of(role: str, members: Mapping[str, Sequence[str]]) -> set[str]:
    """The role and all groups it is in; ``members`` maps group to members."""
    found, grew = {role}, True
    while grew:
        more = {g for g, ms in members.items() if found & set(ms)} - found
        found, grew = found | more, bool(more)
    return found


def secured(
    df: DataFrame,
    role: str,
    policies: Sequence[Policy],
    members: Mapping[str, Sequence[str]] | None = None,
    owner: str | None = None,
    forced: bool = False,
    bypass: Sequence[str] = (),
) -> DataFrame:
    """Rows that at least one policy of the role accepts; none without a policy.

    Roles in ``bypass`` see all rows, and so does the owner unless ``forced``.
    The predicate is part of the plan, so Spark pushes it into the scan.
    """
    mine = groups_of(role, members or {})
    if role in bypass or (role == owner and not forced):
        return df
    accepts = [p.predicate(role) for p in policies if mine & set(p.roles) or "public" in p.roles]
    return df.where(reduce(lambda a, b: a | b, accepts)) if accepts else df.where(F.lit(False))

"""User-defined aggregates: initial state, step, merge of partials, final."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from tablewright.operators.scale import FAN, cols


@dataclass(frozen=True)
class UserAggregate:
    """An aggregate in four parts.

    ``step`` folds values of one group (a dict of numpy arrays) into a state
    tuple, ``merge`` joins two states, ``final`` turns a state into the result
    tuple. ``state`` and ``result`` are DDL of those tuples. Keys stay Arrow
    values throughout, so keys of any type group exactly.
    """

    state: str
    result: str
    init: Callable[[], tuple]
    step: Callable[[tuple, dict[str, np.ndarray]], tuple]
    merge: Callable[[tuple, tuple], tuple]
    final: Callable[[tuple], tuple]

    def over(self, df: DataFrame, by: str | Sequence[str], columns: Sequence[str], groups_held: int = 50_000) -> DataFrame:
        """Aggregate ``columns`` per group.

        Each task folds its rows to one state per group, so a group of any size
        leaves a task as one row; beyond ``groups_held`` states a task sends on
        what it has. The states are merged in two rounds, first in salted
        groups, so the many states of a hot group do not meet in one task either.
        """
        by = cols(by)
        keys = StructType([df.schema[k] for k in by])
        states = _parse_datatype_string(self.state)
        partial = StructType([*keys.fields, *states.fields])
        final = StructType([*keys.fields, *_parse_datatype_string(self.result).fields])
        arrow = {kind: to_arrow_schema(s) for kind, s in (("partial", partial), ("final", final))}
        init, step, merge, finish, names = self.init, self.step, self.merge, self.final, states.names

        def rows_of(pairs, kind: str) -> pa.Table:
            return pa.Table.from_pylist([dict(zip(arrow[kind].names, (*k, *s))) for k, s in pairs], schema=arrow[kind])

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, tuple] = {}
            for batch in batches:
                groups = pa.Table.from_batches([batch]).group_by(by).aggregate([(c, "list") for c in columns])
                values = [groups.column(f"{c}_list").combine_chunks() for c in columns]
                for i, key in enumerate(zip(*(groups.column(k).to_pylist() for k in by))):
                    rows = {c: v[i].values.to_numpy(zero_copy_only=False) for c, v in zip(columns, values)}
                    held[key] = step(held[key] if key in held else init(), rows)
                if len(held) >= groups_held:
                    yield from rows_of(held.items(), "partial").to_batches()
                    held = {}
            yield from rows_of(held.items(), "partial").to_batches()

        def joined(table) -> tuple:
            out = None
            for row in table.select(names).to_pylist():
                state = tuple(row.values())
                out = state if out is None else merge(out, state)
            return out

        def merge_some(table):
            return rows_of([(tuple(table.column(k)[0].as_py() for k in by), joined(table))], "partial")

        def merge_last(table):
            return rows_of([(tuple(table.column(k)[0].as_py() for k in by), finish(joined(table)))], "final")

        folded = df.select(*dict.fromkeys([*by, *columns])).mapInArrow(fold, partial)
        salted = folded.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(FAN)))
        return salted.groupBy(*by, "_salt").applyInArrow(merge_some, partial).groupBy(*by).applyInArrow(merge_last, final)


def weighted_mean() -> UserAggregate:
    """Mean of a first column weighted by a second one; rows with a null do not count."""

    def step(state: tuple, rows: dict[str, np.ndarray]) -> tuple:
        value, weight = (np.asarray(v, dtype=float) for v in rows.values())
        known = ~(np.isnan(value) | np.isnan(weight))
        return state[0] + float((value * weight)[known].sum()), state[1] + float(weight[known].sum())

    return UserAggregate(
        "total double, weight double", "mean double", lambda: (0.0, 0.0), step,
        lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: (s[0] / s[1] if s[1] else None,),
    )

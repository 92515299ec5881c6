"""Scalar functions that Spark lacks or spells differently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LSN_LOW = (1 << 32) - 1


def text_concat(*parts: Column) -> Column:
    """``a || b``: numbers become text, a null makes the result null."""
    return F.concat(*[p.cast("string") for p in parts])


def int_div(a: str, b: str) -> Column:
    """Integer division of two SQL expressions, truncating toward zero."""
    return F.expr(f"({a}) div ({b})")


def message(template: str, *args: Column) -> Column:
    """Fill ``%`` marks in order; ``%%`` is a percent sign, null prints <NULL>."""
    pieces = template.replace("%%", "\0").split("%")
    if len(pieces) != len(args) + 1:
        raise ValueError("marks and arguments differ in number")
    out = [F.lit(pieces[0].replace("\0", "%"))]
    for arg, piece in zip(args, pieces[1:]):
        out += [F.coalesce(arg.cast("string"), F.lit("<NULL>")), F.lit(piece.replace("\0", "%"))]
    return F.concat(*out)


def array_length(array: Column) -> Column:
    """Number of elements; null for an empty or null array."""
    return F.nullif(F.when(array.isNotNull(), F.size(array)), F.lit(0))


def size_pretty(size: Column) -> Column:
    """Bytes in the largest unit of which there are ten or more, rounded half up."""
    amount, sign = F.abs(size), F.when(size < 0, F.lit("-")).otherwise(F.lit(""))
    out = F.when(amount < 10 << 10, F.concat(size.cast("string"), F.lit(" bytes")))
    for step, unit in enumerate(["kB", "MB", "GB", "TB", "PB"], start=1):
        # In half units, so that integers round exactly.
        halves = F.shiftright(amount.cast("bigint"), 10 * step - 1)
        text = F.concat(sign, F.shiftright(halves + 1, 1).cast("string"), F.lit(f" {unit}"))
        out = out.when(halves < (20 << 10) - 1 if unit != "PB" else size.isNotNull(), text)
    return out


def position_number(text: Column) -> Column:
    """Log position ``hi/lo`` in hex as a number."""
    halves = F.split(text, "/")
    high = F.conv(F.element_at(halves, 1), 16, 10).cast("bigint")
    low = F.conv(F.element_at(halves, 2), 16, 10).cast("bigint")
    return F.shiftleft(high, 32) + low


def position_text(number: Column) -> Column:
    return F.concat(F.hex(F.shiftrightunsigned(number, 32)), F.lit("/"), F.hex(number.bitwiseAND(F.lit(LSN_LOW))))


def position_diff(ahead: Column, behind: Column) -> Column:
    """Bytes between two positions given as text."""
    return position_number(ahead) - position_number(behind)


def times_counter(times: Column, start: int = 1) -> Column:
    return F.lit(start) * times


# -- text of statements for remote servers --------------------------------

def quote_identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def quote_literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'"


def quote_literal_column(value: Column) -> Column:
    """A column as literals of a statement."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def format_sql(template: str, *args) -> str:
    """``%I`` identifier, ``%L`` literal, ``%s`` text, ``%%`` percent sign."""
    import re

    rest = iter(args)
    fill = {"I": lambda: quote_identifier(next(rest)), "L": lambda: quote_literal(next(rest)), "s": lambda: str(next(rest)), "%": lambda: "%"}
    return re.sub("%([ILs%])", lambda m: fill[m.group(1)](), template)

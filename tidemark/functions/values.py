"""Column expressions for typed values and money."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _unreadable(column: Column, kind: str) -> Column:
    """Whether a text is no number or date at first sight: a letter in front, or a fraction where there is none.

    Others may be so too. ``try_cast`` makes and catches an exception for each, which takes
    far longer than a good value; these are spared it. Other columns than text have none.
    """
    text = column.cast("string")
    plain = (text >= "A") & (text < "{")
    if kind in ("int", "bigint"):
        plain = plain | F.contains(text, F.lit("."))
    return (F.typeof(column) == "string") & plain


def typed(name: str, kind: str, strict: bool = False) -> Column:
    """A raw string column as its silver type.

    Text is trimmed (spaces only). Anything else is cast; a value that does not
    parse becomes NULL, or fails the job when ``strict``.
    """
    column = F.col(name)
    if kind == "string":
        return F.trim(column).alias(name)
    if strict:
        return column.cast(kind).alias(name)
    value = column.try_cast(kind)
    if kind in ("int", "bigint", "date") or kind.startswith("decimal"):
        value = F.when(~_unreadable(column, kind), value)
    return value.alias(name)


def wider(kind: str) -> str:
    """A type that also holds what a little overflows ``kind``: casting to it raises nothing that has to be caught."""
    if kind == "int":
        return "bigint"
    if kind.startswith("decimal("):
        precision, scale = kind.removeprefix("decimal(").rstrip(")").split(",")
        if int(precision) < 18:
            return f"decimal(18,{int(scale)})"
    return kind


def narrowed(name: str, kind: str) -> Column:
    """A column :func:`typed` as the :func:`wider` kind as its own; values out of range become NULL, unraised."""
    column = F.col(name)
    if wider(kind) == kind:
        return column
    if kind == "int":
        least, most = F.lit(-(2**31)), F.lit(2**31 - 1)
    else:
        precision, scale = (int(n) for n in kind.removeprefix("decimal(").rstrip(")").split(","))
        most = F.lit(Decimal(10**precision - 1).scaleb(-scale))
        least = F.lit(-Decimal(10**precision - 1).scaleb(-scale))
    return F.when((column >= least) & (column <= most), column.cast(kind)).alias(name)


def line_revenue() -> Column:
    return F.col("quantity") * F.col("unit_price")


def money(column: Column) -> Column:
    return column.cast(MONEY)


def average(amount: Column, count: Column) -> Column:
    """Money per unit; NULL instead of an error if there are no units."""
    return money(F.try_divide(amount, count))

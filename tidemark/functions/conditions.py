"""Column expressions for quality rules and change detection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def broken_rules(rules: Mapping[str, str]) -> Column:
    """Messages of the rules a row breaks, in rule order (empty array if none).

    Empty texts stand for rules that hold and are removed: unlike ``array_compact``,
    ``array_remove`` is compiled, and so are then the rules and what is around them.
    """
    messages = [F.when(F.expr(condition), F.lit(message)).otherwise(F.lit("")) for message, condition in rules.items()]
    return F.array_remove(F.array(*messages), "")


def any_changed(old: str, new: str, columns: Iterable[str]) -> Column:
    """Whether any of ``columns`` differs between two structs; NULL equals NULL."""
    return reduce(
        or_, [~F.col(f"{old}.{name}").eqNullSafe(F.col(f"{new}.{name}")) for name in columns]
    )

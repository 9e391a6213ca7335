"""Raw text columns to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.functions.values import narrowed, typed, wider


def standardize(raw: DataFrame, entity: Entity, strict: bool = False) -> DataFrame:
    """Type the entity's columns in one pass; other columns pass through.

    Snapshot entities also get ``is_active = true``. Values that do not parse
    become NULL and are then caught by the NULL rules; ``strict`` fails instead.

    Numbers are read as a wider type, and those out of range are then told by
    comparing: in one expression Spark would read each of them three times.
    """
    columns = [typed(name, kind if strict else wider(kind), strict) for name, kind in entity.columns.items()]
    others = [F.col(name) for name in raw.columns if name not in entity.columns]
    if entity.snapshot:
        others.append(F.lit(True).alias("is_active"))
    read = raw.select(*columns, *others)
    if strict:
        return read
    return read.select(*[narrowed(name, kind) for name, kind in entity.columns.items()], *[F.col(name) for name in read.columns[len(columns):]])

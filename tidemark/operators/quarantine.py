"""Which rejected rows are not in the quarantine yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_yet_quarantined(
    invalid: DataFrame, quarantined: DataFrame, key: str, null_safe: bool = True
) -> DataFrame:
    """Rejected rows whose (batch, key) is not stored; all copies of a new key stay.

    With ``null_safe`` a NULL key matches a stored NULL key of the same batch, so
    loading a batch twice adds nothing. Without it NULL keys never match and are
    added again, as a plain equality anti-join would do. A key or batch that holds
    most rejected rows is split by the adaptive skew join.
    """
    stored = quarantined.select(
        F.col("batch_id").alias("_batch"), F.col(key).alias("_key")
    ).distinct()
    same_key = F.col(key).eqNullSafe(F.col("_key")) if null_safe else F.col(key) == F.col("_key")
    return invalid.join(stored, (F.col("batch_id") == F.col("_batch")) & same_key, "left_anti")

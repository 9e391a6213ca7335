"""Embeddings as integer vectors, for exact sums and products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.workspace import Workspace

SCALE = 256
#: Entries of this size or more could be rounded by ``floor`` on doubles; they end the job.
LARGEST = 1 << 52


def integer_vectors(rows: DataFrame, work: Workspace, scale: int = SCALE) -> tuple[DataFrame, int, int]:
    """(vec_id long, x array<long>) of ``rows`` (vec_id, embedding), their dimension and largest entry.

    An entry c becomes floor(scale * c). Rows whose vector is null or holds null or
    non-finite entries are left out; so are vectors shorter than the longest one,
    which lack entries. The dimension is 0 if no row remains.
    """
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    # NaN is larger than every number in Spark's order, so the bounds leave it out as well.
    finite = F.forall("embedding", lambda c: c.isNotNull() & (c > F.lit(float("-inf"))) & (c < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    kept = vectors.where(F.col("embedding").isNotNull()).where(finite).select("vec_id", whole.alias("x"))
    largest = F.greatest(F.array_max("x"), -F.array_min("x"))
    table, seen = work.store(
        kept,
        "vectors",
        measures=[F.coalesce(F.max(F.size("x")), F.lit(0)).alias("dims"), F.coalesce(F.max(largest), F.lit(0)).alias("largest")],
    )
    if seen["largest"] >= LARGEST:
        raise ValueError(f"an entry of {seen['largest']} is too large to be exact")
    return table.where(F.size("x") == seen["dims"]), seen["dims"], seen["largest"]


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The integer vectors of an Arrow column, one a row."""
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dims)

"""Whitening of embeddings by polarisation covariances.

1. Entries become integers (``vectors.integer_vectors``). The fit list is each
   distinct vector once: n vectors with per-dimension sums S.
2. Tasks add up the exact squares of the centred values n * x - S for every
   dimension, and of their sums for every pair of dimensions. Squares are added as
   limbs of ``LIMB`` bits in 64-bit integers, so no bit is lost; a task sends one
   number for each dimension and pair, whatever it read.
3. cov(i, j) = (var(i + j) - var(i) - var(j)) / 2. The differences are taken of
   exact integers and divided once, then ``eigh`` gives the components.
4. Every row is projected: its centred vector on each component, over the square
   root of the component's eigenvalue. The covariance of the whitened fit list is
   measured as well.

Only sums (dimensions squared) and components reach the driver. A vector that a
third of all rows share is one row of the fit list, by partial aggregation.

Rows without a vector, or whose vector holds null or non-finite entries or is
shorter than the longest, are dropped; null ids and repeated rows stay, each with
its result. An empty table gives no rows. A component without variance has
whitened 0 and explained 0, and is left out of the identity error. Equal
eigenvalues are in the order of ``eigh``. Entries beyond 2^50 / n would lose bits,
and more than 1,024 dimensions would make too many sums for the driver: both end the
job. Extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import workspace
from tidemark.llm.vectors import SCALE, integer_vectors, matrix

COMPONENTS = 4
#: Rows that are squared together, and bits of a limb: their squares fit 64 bits.
STEP, LIMB = 1024, 26
EXACT = "decimal(38,0)"
#: Part of the whole variance below which a component has none.
NOTHING = 1e-12


def exact_squares(values: np.ndarray) -> np.ndarray:
    """The sum of squares of each column as Python integers; at most ``STEP`` rows below 2^52."""
    high, low = values >> LIMB, values & ((1 << LIMB) - 1)
    parts = (np.einsum("ij,ij->j", a, b).astype(object) for a, b in ((high, high), (high, low), (low, low)))
    return sum(part * (1 << shift) for part, shift in zip(parts, (2 * LIMB, LIMB + 1, 0), strict=True))


def _sums(dims: int):
    """Per task: each dimension's sum."""

    def run(batches):
        total = np.zeros(dims, object)
        for batch in batches:
            total += matrix(batch["x"], dims).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(dims), pa.int32()), "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))}
        )

    return run


def _squares(n: int, sums: np.ndarray):
    """Per task: sums of exact squares of every dimension (i, i) and of every pair's sum (i, j)."""
    dims = len(sums)

    def run(batches):
        total = np.zeros((dims, dims), object)
        for batch in batches:
            whole = matrix(batch["x"], dims)
            for a in range(0, len(whole), STEP):
                centred = whole[a : a + STEP] * n - sums
                np.fill_diagonal(total, total.diagonal() + exact_squares(centred))
                for i in range(dims - 1):
                    total[i, i + 1 :] += exact_squares(centred[:, i : i + 1] + centred[:, i + 1 :])
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(i, pa.int32()),
                "j": pa.array(j, pa.int32()),
                "total": pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0)),
            }
        )

    return run


def covariances(squares: dict[tuple[int, int], int], n: int, dims: int) -> np.ndarray:
    """The covariance matrix from exact sums of squares of n * x - S, each rounded once."""
    out = np.zeros((dims, dims))
    for i in range(dims):
        out[i, i] = squares[i, i] / n**3
        for j in range(i + 1, dims):
            out[i, j] = out[j, i] = (squares[i, j] - squares[i, i] - squares[j, j]) / (2 * n**3)
    return out


def _whitened(centred: np.ndarray, n: int, axes: np.ndarray, scales: np.ndarray) -> np.ndarray:
    return (centred / n) @ axes * scales


def _products(n: int, sums: np.ndarray, axes: np.ndarray, scales: np.ndarray):
    """Per task: the sum of products of whitened values."""

    def run(batches):
        total = np.zeros((len(scales), len(scales)))
        for batch in batches:
            white = _whitened(matrix(batch["x"], len(sums)) * n - sums, n, axes, scales)
            total += white.T @ white
        i, j = np.indices(total.shape)
        columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return run


RESULT = f"vec_id long, component int, n long, deviation {EXACT}, whitened double, explained double, identity_error double"


def _projected(n: int, sums: np.ndarray, axes: np.ndarray, scales: np.ndarray, explained: np.ndarray, error: float):
    count = len(scales)

    def run(batches):
        for batch in batches:
            whole = matrix(batch["x"], len(sums))
            for a in range(0, len(whole), STEP):
                centred = whole[a : a + STEP] * n - sums
                rows = len(centred)
                deviation = [Decimal(int(d)) for d in exact_squares(np.ascontiguousarray(centred.T))]
                owner = pa.array(np.repeat(np.arange(rows), count))
                columns = [
                    batch["vec_id"][a : a + STEP].take(owner),
                    pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                    pa.array(np.full(rows * count, n), pa.int64()),
                    pa.array(deviation, pa.decimal128(38, 0)).take(owner),
                    pa.array(_whitened(centred, n, axes, scales).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return run


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row for each remaining row of ``rows`` (vec_id, embedding) and component.

    vec_id, component (from 1), n, deviation (sum over dimensions of (n * x - S)^2),
    whitened, explained (part of the whole variance) and identity_error (largest
    absolute entry of the whitened fit list's covariance minus the identity).
    """
    spark = rows.sparkSession
    work = workspace(spark, "whitening")
    vectors, dims, largest = integer_vectors(rows, work, scale)
    if not dims:
        return spark.createDataFrame([], RESULT)
    fit, seen = work.store(vectors.select("x").distinct(), "fit")
    n = seen["rows"]
    if n * largest >= 1 << 50 or dims > STEP:
        raise ValueError(f"squares of {n} vectors of {dims} entries up to {largest} would lose bits")
    per_dimension = fit.mapInArrow(_sums(dims), f"i int, total {EXACT}").groupBy("i").agg(F.sum("total").alias("total"))
    sums = np.zeros(dims, np.int64)
    for row in per_dimension.collect():  # one row a dimension
        sums[row["i"]] = int(row["total"])
    per_pair = fit.mapInArrow(_squares(n, sums), f"i int, j int, total {EXACT}").groupBy("i", "j").agg(F.sum("total").alias("total"))
    squares = {(r["i"], r["j"]): int(r["total"]) for r in per_pair.collect()}  # one row a pair of dimensions
    whole = covariances(squares, n, dims)
    values, axes = np.linalg.eigh(whole)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = float(np.trace(whole))
    varies = values > NOTHING * trace
    scales = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1)), 0.0)
    explained = np.where(varies, values, 0.0) / (trace or 1.0)
    products = fit.mapInArrow(_products(n, sums, axes, scales), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    found = np.zeros((len(values), len(values)))
    for row in products.collect():  # components squared
        found[row["i"], row["j"]] = row["total"] / n
    off = np.abs(found - np.eye(len(values)))[np.ix_(varies, varies)]
    return vectors.mapInArrow(_projected(n, sums, axes, scales, explained, float(off.max(initial=0.0))), RESULT)

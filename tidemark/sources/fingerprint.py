"""Content identity of sources, computed by Spark tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.sources.csv import read_raw

#: Hashes are summed in pieces of these bits (the uppermost has one more), so that the sums are longs.
PIECE = 21
PIECES = ("first_upper", "first_middle", "first_lower", "second_upper", "second_middle", "second_lower")
#: The number of rows, and the sums of the pieces of both hashes.
PARTS = ("content_rows", *PIECES)
HASHES = tuple(f"_{name}" for name in PIECES)


def with_hashes(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two independent 64-bit hashes of each row of text columns, in pieces; a NULL differs from every text."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    hashes = [F.xxhash64(F.lit(seed), *values) for seed in ("first", "second")]
    low = F.lit((1 << PIECE) - 1)
    pieces = [p for h in hashes for p in (F.shiftright(h, 2 * PIECE), F.shiftright(h, PIECE).bitwiseAND(low), h.bitwiseAND(low))]
    return rows.select("*", *[piece.alias(name) for piece, name in zip(pieces, HASHES, strict=True)])


def _whole(parts: list, one) -> list:
    """Rows and the sums of both hashes, of the sums of their pieces; ``one`` makes a number of their kind."""
    shift = one(1 << PIECE)
    rows, *sums = parts
    return [rows, *[(upper * shift + middle) * shift + lower for upper, middle, lower in (sums[:3], sums[3:])]]


def content_parts() -> list[Column]:
    """What identifies a multiset of rows ``with_hashes``, as aggregates.

    Their number and the sums of both hashes, so neither order nor the number of
    files or tasks matters. Observed aggregates are interpreted row by row, so the
    hashes are columns, which are compiled, and their pieces are summed as longs, in
    which those of 2^41 rows fit.
    """
    parts = [F.count(F.lit(1)), *[F.coalesce(F.sum(name), F.lit(0).cast("bigint")) for name in HASHES]]
    return [part.alias(name) for part, name in zip(parts, PARTS, strict=True)]


def identity(parts: Mapping[str, int]) -> str:
    """The hash of measured :func:`content_parts`."""
    whole = _whole([int(parts[name]) for name in PARTS], int)
    return hashlib.sha256(":".join(map(str, whole)).encode()).hexdigest()


#: The identity of a file with a header only.
NOTHING = identity(dict.fromkeys(PARTS, 0))


def rows_hash(rows: DataFrame, *by: str) -> DataFrame:
    """``file_hash``, the identity of a multiset of rows of text columns; with ``by``, one row for each group."""
    columns = [c for c in rows.columns if c not in by]
    parts = with_hashes(rows, columns).groupBy(*by).agg(*content_parts())
    # Sums of pieces have 19 digits, so those of whole hashes have 33 at most.
    whole = _whole([F.col(name).cast("decimal(19,0)") for name in PARTS], lambda n: F.lit(n).cast("decimal(7,0)"))
    text = F.concat_ws(":", *[part.cast("string") for part in whole])
    return parts.select(*by, F.sha2(text, 256).alias("file_hash"))


def content_hash(
    spark: SparkSession, source: str | list[str], entity: Entity, check_header: bool = True
) -> str:
    """One hash for one CSV source, by its data rows.

    The same rule at every size and layout: header lines, line ends, the order of
    rows and how they are split into files do not count. Bytes are another
    identity, see :func:`file_sha256`.
    """
    return rows_hash(read_raw(spark, source, entity, check_header)).first()["file_hash"]


def file_hashes(spark: SparkSession, paths: str | list[str], entity: Entity, check_header: bool = True) -> DataFrame:
    """``source_file, file_hash`` of every CSV file below ``paths``, in one pass; without those that hold a header only."""
    raw = read_raw(spark, paths, entity, check_header)
    return rows_hash(raw.select("*", F.col("_metadata.file_path").alias("source_file")), "source_file")


def file_sha256(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, length, sha256`` of the bytes of every file; one task reads a file whole.

    For files that a task can hold (Spark reads at most 2 GB in one piece).
    """
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))

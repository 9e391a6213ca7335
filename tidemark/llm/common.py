"""Helpers shared by the operators on documents."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.workspace import Workspace

#: Bytes of text that one step inside a task works on (at least one document).
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def workspace(spark: SparkSession, label: str) -> Workspace:
    """A folder for tables that a returned DataFrame still reads, hence kept."""
    return Workspace(spark, label, keep=True)


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes or characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 16
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def connected_components(spark: SparkSession, edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a long, b long): node, component.

    Alternates the large-star and small-star steps, each of which links a node's
    neighbours to the smallest of them, until no edge changes. A star's centre
    may be hot: neighbours are never gathered, only their minimum is, by a
    partial aggregate. Every step is written to the shared folder.
    """
    checksum = [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("sum"),
    ]

    def both(rows):
        return rows.select("a", "b").union(rows.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(rows, large: bool):
        ways = both(rows)
        near = ways if large else ways.where("b < a")
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        chosen = ways.where("b > a") if large else near
        # Written, so that both sides of the join are dealt out anew, and a hot centre can be split.
        least, _ = work.store(least, f"{name}-{step}-{'large' if large else 'small'}-least")
        linked = chosen.join(least, "a").select(F.col("b").alias("x"), F.col("m").alias("y"))
        if not large:
            linked = linked.union(least.select(F.col("a").alias("x"), F.col("m").alias("y")))
        linked = linked.where("x <> y")
        return linked.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()

    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = work.store(now.distinct(), f"{name}-0", measures=checksum)
    step = 0
    while seen["rows"]:
        step += 1
        now, _ = work.store(star(now, True), f"{name}-{step}-large")
        now, found = work.store(star(now, False), f"{name}-{step}", measures=checksum)
        if found == seen:
            break
        seen = found
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(roots)

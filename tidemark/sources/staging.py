"""Arriving sources on their way into the bronze history: read once, named, then published or dropped.

One scan of the CSV writes every source to a folder of its own below a staging
folder, next to the history, and measures its content. Which of them are new
is decided by content, and those folders become batches by a rename. Until then
readers see nothing (Spark passes over names that begin with ``_``), and a run that
failed leaves only a folder that the next one removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.sources import files
from tidemark.sources.csv import read_raw
from tidemark.sources.fingerprint import NOTHING, content_parts, identity, rows_hash, with_hashes

PREFIX = "_staging-"


class Staging:
    """The staging folder of one run; use as a context manager."""

    def __init__(self, spark: SparkSession, bronze_path: str):
        self.spark = spark
        self.bronze = bronze_path
        self.path = f"{bronze_path}/{PREFIX}{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        for name in files.child_names(self.spark, self.bronze):
            if name.startswith(PREFIX):  # of a run that was lost
                files.remove(self.spark, f"{self.bronze}/{name}")
        return self

    def __exit__(self, *_) -> None:
        files.remove(self.spark, self.path)

    def take(self, sources: Sequence[str], entity: Entity, check_header: bool = True) -> list[str]:
        """Write all sources, each to its own folder; returns their content hashes."""
        raw = read_raw(self.spark, list(sources), entity, check_header).select(
            "*", F.current_timestamp().alias("ingestion_timestamp"), F.col("_metadata.file_path").alias("source_file")
        )
        if len(sources) == 1:
            measured = Observation()
            hashed = with_hashes(raw, entity.raw_columns).observe(measured, *content_parts())
            hashed.select(*raw.columns).write.parquet(f"{self.path}/number=0")
            return [identity(measured.get)]
        numbers = self.spark.createDataFrame(self._numbers(sources), "source_file string, number int")
        numbered = raw.join(F.broadcast(numbers), "source_file").select(*raw.columns, "number")
        numbered.write.partitionBy("number").parquet(self.path)
        staged = self.spark.read.schema(f"{entity.raw_schema}, number int").parquet(self.path)
        hashes = dict.fromkeys(range(len(sources)), NOTHING)
        hashes |= {row["number"]: row["file_hash"] for row in rows_hash(staged, "number").collect()}  # one row a source
        return [hashes[number] for number in range(len(sources))]

    def _numbers(self, sources: Sequence[str]) -> list[tuple[str, int]]:
        """Which source each of the files belongs to, by the name that rows carry: one row a file."""
        number = {files.qualified(self.spark, source): n for n, source in enumerate(sources)}
        listed = self.spark.read.format("binaryFile").load(list(sources)).select("path", F.col("_metadata.file_path").alias("name"))
        found = []
        for file in listed.collect():
            path = file["path"]
            while path not in number and "/" in path:
                path = path.rpartition("/")[0]
            if path not in number:
                raise ValueError(f"{file['path']} is of none of the sources; give files or folders, not patterns")
            found.append((file["name"], number[path]))
        return found

    def publish(self, number: int, batch_id: str) -> None:
        """Make a source the rows of its batch, in the place of what an earlier try left."""
        target = f"{self.bronze}/batch_id={batch_id}"
        if files.exists(self.spark, f"{self.path}/number={number}"):
            files.move(self.spark, f"{self.path}/number={number}", target)
        else:  # a header only
            files.remove(self.spark, target)

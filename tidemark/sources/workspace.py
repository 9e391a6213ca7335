"""Intermediate results as written tables in the cluster's shared folder.

A written table survives lost executors and cuts the lineage; it is also read
back with column pruning and exact sizes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


class Workspace:
    """A private subfolder for one job; use as a context manager.

    With ``keep`` it stays until the session's JVM ends, for tables that a returned
    DataFrame still reads.
    """

    def __init__(self, spark: SparkSession, label: str = "work", keep: bool = False):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.keep = keep
        if keep:
            files.remove_at_exit(spark, self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        if not self.keep:
            files.remove(self.spark, self.path)

    def store(
        self, rows: DataFrame, name: str, *, partition_by: tuple[str, ...] = (), measures=None
    ) -> tuple[DataFrame, dict]:
        """Write ``rows`` and read them back, with measures taken during the write.

        Without ``measures`` the row count is taken as ``rows``.
        """
        target = f"{self.path}/{name}"
        observed = Observation()
        columns = measures or [F.count(F.lit(1)).alias("rows")]
        schema = rows.schema
        writer = rows.observe(observed, *columns).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        return self.spark.read.schema(schema).parquet(target), observed.get

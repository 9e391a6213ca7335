"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE picks join strategies and partition sizes from measured sizes, and splits
# a hot join key over many tasks. Forcing the split keeps it active when a later
# aggregation would otherwise have reused the join's partitioning. A join whose
# measured build partitions all stay small is hashed instead of sorted. A task that
# writes a partitioned table keeps a few files open instead of sorting its rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session someone else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """The settings for the time of one job; the caller's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        yield tune(spark)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def build_session(app_name: str = "tidemark", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

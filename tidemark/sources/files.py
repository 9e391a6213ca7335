"""Small helpers over the Hadoop file system Spark itself uses.

They need the classic session's JVM gateway; a Spark Connect session has none.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def child_names(spark: SparkSession, path: str, glob: bool = False) -> list[str]:
    """Names directly below a directory (empty if it does not exist), or of a glob's matches."""
    system, target = _open(spark, path)
    if glob:
        return sorted(status.getPath().getName() for status in system.globStatus(target) or ())
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, as Spark's file sources name it."""
    system, target = _open(spark, path)
    return system.makeQualified(target).toString()


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder, in the place of what ``target`` was; one step in most stores."""
    system, old = _open(spark, path)
    _, new = _open(spark, target)
    system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{path} could not be renamed to {target}")


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes when the session's JVM ends."""
    system, target = _open(spark, path)
    system.mkdirs(target)
    system.deleteOnExit(target)

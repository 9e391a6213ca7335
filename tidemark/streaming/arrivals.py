"""A folder of arriving CSV files as a stream of entity batches."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.contracts import Entity
from tidemark.plans.jobs import Layout, Options, run_entity_batches
from tidemark.sources.files import child_names

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


logger = logging.getLogger(__name__)

# Spark's file stream forgets files that are older than the newest one by more than
# this; a hundred years keep late ones (backfills and copies that keep their times).
OLDEST = "36500d"


def ignored_files(spark: SparkSession, folder: str, pattern: str | None) -> list[str]:
    """Names in ``folder`` that the stream passes over because of ``pattern``."""
    if pattern is None:
        return []
    names = set(child_names(spark, folder))
    return sorted(names - set(child_names(spark, f"{folder}/{pattern}", glob=True)))


def arriving_files(
    spark: SparkSession, folder: str, pattern: str | None = None, files_per_trigger: int = 100
) -> DataFrame:
    """One row per file, oldest first, however old.

    Only names and times are read here; a header-only file is an arrival too.
    ``pattern`` is a glob over names, case-sensitive; without it every file counts
    (names that begin with ``_`` or ``.`` are hidden from Spark).
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("maxFileAge", OLDEST)
    )
    if pattern is not None:
        stream = stream.option("pathGlobFilter", pattern)
    return stream.load(folder).select("path", "modificationTime")


def process_arrivals(
    spark: SparkSession,
    entity: Entity,
    folder: str,
    layout: Layout,
    checkpoint: str,
    options: Options = Options(),
    pattern: str | None = None,
    files_per_trigger: int = 100,
) -> StreamingQuery:
    """Run every file that is in ``folder`` now as a batch, oldest first, then stop.

    The files of a trigger are one run, with as many Spark jobs for a thousand of them as for
    one. Files that ``pattern`` leaves out are named in the log. Start it again to pick
    up what arrived since. The stream remembers the path of every file that is still
    in the folder, in the driver: move finished files away when they are millions. The
    batch itself recognises content, so a renamed copy is still skipped.
    """

    ignored = ignored_files(spark, folder, pattern)
    if ignored:
        logger.warning("%d files of %s do not match %s: %s", len(ignored), folder, pattern, ignored[:20])

    def run(files: DataFrame, _: int) -> None:
        arrived = files.orderBy("modificationTime", "path").collect()  # at most files_per_trigger
        run_entity_batches(spark, entity, [file["path"] for file in arrived], layout, options)

    return (
        arriving_files(spark, folder, pattern, files_per_trigger)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

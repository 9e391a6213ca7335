"""File states: what has been ingested, what is finished, what to do next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The recorded states.
BRONZE_WRITTEN = "BRONZE_WRITTEN"
SUCCESS = "SUCCESS"

EVENT_SCHEMA = (
    "entity string, source_file string, file_hash string, batch_id string, "
    "status string, processed_at timestamp"
)


def latest_states(events: DataFrame, *by: str) -> DataFrame:
    """The newest event of every file (by default per entity and content hash).

    Of events with the same time the finished one counts, then the larger batch id.
    """
    by = by or ("entity", "file_hash")
    rest = [name for name in events.columns if name not in by]
    newest = F.max_by(F.struct(*rest), F.struct("processed_at", "status", "batch_id"))
    return events.groupBy(*by).agg(newest.alias("event")).select(*by, "event.*")


def plan_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """Decide for every fingerprinted file: ``run``, ``resume`` or ``skip``.

    Files are identified by entity and content, not by name. A file whose batch
    reached bronze resumes under the same ``batch_id``; any state not known here
    is reported as ``unknown``.
    """
    states = latest_states(events).select("entity", "file_hash", "batch_id", "status")
    action = (
        F.when(F.col("status").isNull(), "run")
        .when(F.col("status") == BRONZE_WRITTEN, "resume")
        .when(F.col("status") == SUCCESS, "skip")
        .otherwise("unknown")
    )
    return files.join(states, ["entity", "file_hash"], "left").withColumn("action", action)

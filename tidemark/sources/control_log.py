"""The log of file states."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.control import EVENT_SCHEMA, latest_states
from tidemark.sources.tables import EventLog


def event_log(spark: SparkSession, control_path: str) -> EventLog:
    return EventLog(spark, control_path, EVENT_SCHEMA)


def read_events(spark: SparkSession, control_path: str) -> DataFrame:
    return event_log(spark, control_path).read()


def record_states(spark: SparkSession, control_path: str, entity: str, events: Sequence[tuple[str, str, str]], *, status: str) -> None:
    """Add one event for each (source file, content hash, batch id), all at once."""
    now = datetime.now(timezone.utc)
    rows = [(entity, source, file_hash, batch_id, status, now) for source, file_hash, batch_id in events]
    event_log(spark, control_path).append(spark.createDataFrame(rows, EVENT_SCHEMA))


def record_state(
    spark: SparkSession,
    control_path: str,
    *,
    entity: str,
    source_file: str,
    file_hash: str,
    batch_id: str,
    status: str,
) -> None:
    record_states(spark, control_path, entity, [(source_file, file_hash, batch_id)], status=status)


def file_state(spark: SparkSession, control_path: str, entity: str, file_hash: str) -> Row | None:
    """The newest event of one file, or None if it was never seen."""
    seen = read_events(spark, control_path).where(
        (F.col("entity") == entity) & (F.col("file_hash") == file_hash)
    )
    return latest_states(seen).first()

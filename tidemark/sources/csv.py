"""Raw CSV files: declared all-text schema, lineage, and the bronze history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import MISFIT, Entity
from tidemark.sources.tables import replace_batch


def read_raw(
    spark: SparkSession, path: str | list[str], entity: Entity, check_header: bool = True
) -> DataFrame:
    """All columns as text, in file order, without inference.

    Columns bind by position. ``check_header`` fails on a header that disagrees
    with the declared columns; without it a reordered file is read as it comes.
    Rows of too few or too many values are filled up with NULL or cut; an entity
    ``with_misfits`` also has their whole line.
    """
    reader = spark.read.option("header", True).option("enforceSchema", not check_header).schema(entity.raw_schema)
    if entity.misfits:
        reader = reader.option("columnNameOfCorruptRecord", MISFIT)
    return reader.csv(path)


def with_lineage(raw: DataFrame, batch_id: str) -> DataFrame:
    """Add ingestion time, source file and batch id to freshly read rows."""
    return raw.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
    )


def ingest(
    spark: SparkSession,
    source: str | list[str],
    entity: Entity,
    bronze_path: str,
    batch_id: str,
    check_header: bool = True,
) -> str:
    """Add a source to the bronze history as one batch; repeating it changes nothing."""
    raw = read_raw(spark, source, entity, check_header)
    replace_batch(with_lineage(raw, batch_id), bronze_path)
    return batch_id

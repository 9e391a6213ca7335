"""From raw documents to token ids: the stages of the corpus pipeline, in order.

Each stage takes what its predecessor kept and returns the columns of documents,
the last one token ids. Nulls, empty texts and repeated rows are handled as each
operator's docstring says; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, near_dedup, piece_encoding, quality_votes
from tidemark.llm.common import documents, importable, workspace


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled neighbours vote for quality stay."""
    importable(spark)
    votes = quality_votes.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_votes.good(docs, votes)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space stays."""
    importable(spark)
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over five words stays."""
    importable(spark)
    return near_dedup.without_near_copies(docs, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also with other numbers and names, stay."""
    importable(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding them gives the text back."""
    importable(spark)
    return piece_encoding.encode_and_check(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("piece_encoding", piece_ids),
]
#: Latent vectors and pieces have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs, work = documents(spark, sf_dir), workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs, _ = work.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

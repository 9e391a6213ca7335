"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import pytest
from helpers import ROWS, table

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    exact_dedup,
    language,
    near_dedup,
    piece_encoding,
    pseudonyms,
    quality_votes,
    suffix_dedup,
    token_files,
)


def tokens(docs, tmp):
    token_files.write(docs, tmp)
    return token_files.read(docs.sparkSession, tmp)


def labels(spark):
    return spark.createDataFrame([(1, 1, None), (5, 0, None), (None, 1, None), (9, None, None)], "doc_id long, quality int, text string")


def items(spark, rows=((0, "then it sleeps for a while"), (1, None), (2, ""), (None, "x y z"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "token_files": tokens,
    "near_dedup": lambda docs, tmp: near_dedup.near_duplicates(docs),
    "suffix_dedup": lambda docs, tmp: suffix_dedup.without_repeats(docs),
    "language": lambda docs, tmp: language.predict(docs, language.fit(docs)),
    "exact_dedup": lambda docs, tmp: exact_dedup.exact_duplicates(docs),
    "pseudonyms": lambda docs, tmp: pseudonyms.pseudonymise(docs, "k"),
    "quality_votes": lambda docs, tmp: quality_votes.score(docs, quality_votes.fit(docs, labels(docs.sparkSession))),
    "decontaminate": lambda docs, tmp: decontaminate.decontaminate(docs, items(docs.sparkSession)),
    "piece_encoding": lambda docs, tmp: piece_encoding.encode_digests(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, tmp_path, name):
    got = [r["doc_id"] for r in OPERATORS[name](table(spark), str(tmp_path / "x")).collect()]
    assert sorted(got, key=str) == sorted([i for i, _ in ROWS], key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, tmp_path, name):
    assert OPERATORS[name](table(spark, []), str(tmp_path / "x")).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(1, 1), (5, 1), (9, 1), (10, 1), (2, 1), (7, 1)]
    spark.createDataFrame(rows, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    items(spark, [(0, "nothing of this is anywhere in the documents at all")]).write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns_and_clean_rows(spark, folder, tmp_path):
    docs = table(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns
        docs = after
    # Of equal texts the longest stays: 2 of 1, 2 and 7; 6 of 3, 4 and 6.
    assert sorted((r.doc_id for r in docs.collect()), key=str) == [10, 11, 2, 5, 6, 9, None]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert all(r.round_trip for r in out) and len(out) == 7


def test_stages_on_an_empty_table(spark, folder):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), folder).collect() == []


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "near_dedup", "decontamination", "piece_encoding",
    ]

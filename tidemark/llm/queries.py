"""One query for each operator over its whole table, and the SQL to compare with."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, piece_encoding, pseudonyms, quality_votes, token_files, warc
from tidemark.llm.common import documents, importable, workspace
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.prefix_trie import prefix_trie
from tidemark.llm.suffix_dedup import without_repeats
from tidemark.llm.voronoi_topk import top_k
from tidemark.llm.whitening import whiten


def op1_token_files(spark, sf_dir):
    path = f"{workspace(spark, 'token-files').path}/ids"
    token_files.write(documents(spark, sf_dir), path)
    return token_files.read(spark, path)


def op5_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir)).drop("row_key")


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), percent=85).drop("row_key")


def op3_suffix_dedup(spark, sf_dir):
    cut = without_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op4_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.fit(docs))


def op6_pseudonyms(spark, sf_dir):
    key = spark.conf.get("spark.tidemark.pseudonyms.key", "for comparisons only")
    return pseudonyms.pseudonymise(documents(spark, sf_dir), key)


def op7_warc(spark, sf_dir):
    path = f"{workspace(spark, 'warc').path}/archive"
    importable(spark)
    warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.pages(warc.read(spark, path))


def op8_quality_votes(spark, sf_dir):
    docs = documents(spark, sf_dir)
    votes = quality_votes.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_votes.score(docs, votes)


def op9_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_piece_encoding(spark, sf_dir):
    return piece_encoding.encode_digests(documents(spark, sf_dir))


def op11_whitening(spark, sf_dir):
    importable(spark)
    white = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op12_prefix_trie(spark, sf_dir):
    importable(spark)
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_voronoi_topk(spark, sf_dir):
    importable(spark)
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def all_queries():
    return {
        "op1_token_files": op1_token_files,
        "op2_near_dedup": op2_near_dedup,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_language": op4_language,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_pseudonyms": op6_pseudonyms,
        "op7_warc": op7_warc,
        "op8_quality_votes": op8_quality_votes,
        "op9_decontaminate": op9_decontaminate,
        "op10_piece_encoding": op10_piece_encoding,
        "op11_whitening": op11_whitening,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_voronoi_topk": op13_voronoi_topk,
    }

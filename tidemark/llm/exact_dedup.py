"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every task fingerprints its documents (64 bits of the SHA-256 of the text
   without white space) and closes a packet every ``packet_rows`` documents. A
   packet sends each owner of a hash range its distinct fingerprints, sorted, as
   Golomb-coded differences, with a bit for those that the packet holds twice.
2. Owners decode what all packets sent and answer each packet with a bitmap:
   is the fingerprint known from elsewhere, or repeated in the packet?
3. Only suspects' texts are grouped, by their bytes. All other documents are
   unique and take part by their fingerprint row alone.

A packet sends an equal text once however often it holds it, so a text that a
third of all rows share reaches its owner once a packet. Suspects' texts are
matched by fingerprint and a salt, and grouped with partial aggregation.

Nulls count as the empty text; empty texts are equal to each other. Rows that
repeat a doc_id are rows of their own; of rows that tie in length and doc_id one
stays. A null doc_id ranks after all others. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, fresh, workspace

WHITE = b" \t\n\v\f\r"
PACKET_ROWS = 1 << 16
#: Fingerprints that one owner holds at most on average.
OWNER_ROWS = 1 << 20
SALTS = 16


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned 64-bit values: count, Rice parameter, first differences."""
    n = len(values)
    if not n:
        return b""
    steps = np.diff(values, prepend=np.uint64(0))
    mean = max(1, int(values[-1]) // n)
    k = min(63, mean.bit_length() - 1)
    quotient = (steps >> np.uint64(k)).astype(np.int64)
    stops = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    rest = np.unpackbits(steps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)[:, 64 - k :]
    head = np.array([n, k, len(unary)], "<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    n, k, length = (int(x) for x in np.frombuffer(blob[:24], "<u8"))
    cut = 24 + (length + 7) // 8
    unary = np.unpackbits(np.frombuffer(blob[24:cut], np.uint8), count=length)
    quotient = np.diff(np.flatnonzero(unary), prepend=-1).astype(np.uint64) - np.uint64(1)
    bits = np.zeros((n, 64), np.uint8)
    if k:
        rest = np.unpackbits(np.frombuffer(blob[cut:], np.uint8), count=n * k)
        bits[:, 64 - k :] = rest.reshape(n, k)
    rest = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((quotient << np.uint64(k)) + rest, dtype=np.uint64)


FINGERPRINTS = (
    "kind string, packet long, owner int, pos int, seq int, doc_id long, row_key long, points int, sha binary, "
    "n int, hashes binary, twice binary"
)


def _fingerprints(owners: int, packet_rows: int):
    def packet_rows_of(packet: int, rows: list) -> list[pa.RecordBatch]:
        ids, keys, points, shas = zip(*rows, strict=True)
        prints = np.frombuffer(b"".join(s[:8] for s in shas), ">u8").astype(np.uint64)
        distinct, place, times = np.unique(prints, return_inverse=True, return_counts=True)
        owner = _owner(distinct, owners)
        cuts = np.searchsorted(owner, np.arange(owners + 1))
        none = [None] * len(rows)
        out = [
            _batch("row", packet, owner[place], place - cuts[owner[place]], range(len(rows)), ids, keys, points, shas, none, none, none)
        ]
        used = np.unique(owner)
        none = [None] * len(used)
        hashes = [golomb_encode(distinct[cuts[o] : cuts[o + 1]]) for o in used]
        twice = [np.packbits(times[cuts[o] : cuts[o + 1]] > 1).tobytes() for o in used]
        n = [int(cuts[o + 1] - cuts[o]) for o in used]
        return [*out, _batch("sent", packet, used, none, none, none, none, none, none, n, hashes, twice)]

    def run(batches):
        base, rows, packet = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            texts = byte_texts(batch["text"])
            long = pc.fill_null(pc.utf8_length(batch["text"]), 0).to_pylist()
            columns = batch["doc_id"].to_pylist(), batch["row_key"].to_pylist(), texts, long
            for doc_id, key, text, points in zip(*columns, strict=True):
                rows.append((doc_id, key, points, hashlib.sha256(text.translate(None, WHITE)).digest()))
                if len(rows) == packet_rows:
                    yield from packet_rows_of(base + packet, rows)
                    rows, packet = [], packet + 1
        if rows:
            yield from packet_rows_of(base + packet, rows)

    return run


def _owner(prints: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold equal ranges of the hash, so sorted hashes have sorted owners."""
    return ((prints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int32)


def _batch(kind, packet, owner, pos, seq, ids, keys, points, shas, n, hashes, twice) -> pa.RecordBatch:
    size = len(owner)
    columns = {
        "kind": pa.array([kind] * size),
        "packet": pa.array(np.full(size, packet), pa.int64()),
        "owner": pa.array(owner, pa.int32()),
        "pos": pa.array(pos, pa.int32()),
        "seq": pa.array(seq, pa.int32()),
        "doc_id": pa.array(ids, pa.int64()),
        "row_key": pa.array(keys, pa.int64()),
        "points": pa.array(points, pa.int32()),
        "sha": pa.array(shas, pa.binary()),
        "n": pa.array(n, pa.int32()),
        "hashes": pa.array(hashes, pa.binary()),
        "twice": pa.array(twice, pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _answers(sent: pd.DataFrame) -> pd.DataFrame:
    """For one owner: which fingerprints of each packet are duplicates."""
    lists = [golomb_decode(x) for x in sent["hashes"]]
    twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(sent["twice"], sent["n"], strict=True)]
    _, place, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    known = (times[place] > 1) | (np.concatenate(twice) > 0)
    parts = np.split(known, np.cumsum([len(x) for x in lists])[:-1])
    return pd.DataFrame(
        {"packet": sent["packet"], "owner": sent["owner"], "bits": [np.packbits(x).tobytes() for x in parts]}
    )


def _normalised(batches):
    for batch in batches:
        texts = [t.translate(None, WHITE) for t in byte_texts(batch["text"])]
        shas = [hashlib.sha256(t).digest() for t in texts]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "sha": pa.array(shas, pa.binary()),
                "body": pa.array(texts, pa.binary()),
            }
        )


def row_key(docs: DataFrame):
    """A hash of doc_id and text; rows that share it are the same document."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that are the same, one."""
    name = fresh(docs, "row_key")
    kept = exact_duplicates(docs).where("kept").select(F.col("row_key").alias(name)).distinct()
    rows = docs.withColumn(name, row_key(docs)).join(kept, name, "left_semi")
    return rows.dropDuplicates([name]).select(docs.columns)


def exact_duplicates(docs: DataFrame, packet_rows: int = PACKET_ROWS, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row_key.

    ``row_key`` is ``row_key(docs)``, by which the row can be found again. The row with the most code points stays, then the one with the smallest doc_id.
    """
    spark = docs.sparkSession
    work = workspace(spark, "exact-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("row_key"), "text")
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // owner_rows))
    table, _ = work.store(
        texts.mapInArrow(_fingerprints(owners, packet_rows), FINGERPRINTS), "prints", partition_by=("kind",)
    )
    rows = table.where("kind = 'row'").select("packet", "owner", "pos", "seq", "doc_id", "row_key", "points", "sha")
    sent = table.where("kind = 'sent'").select("packet", "owner", "n", "hashes", "twice")
    bits = sent.groupBy("owner").applyInPandas(_answers, "packet long, owner int, bits binary")
    flag = "shiftright(cast(conv(hex(substring(bits, cast(pos div 8 as int) + 1, 1)), 16, 10) as int), 7 - pos % 8) & 1 = 1"
    flagged, _ = work.store(
        rows.join(bits, ["packet", "owner"]).select("packet", "seq", "doc_id", "row_key", "points", "sha", F.expr(flag).alias("suspect")),
        "flagged",
    )
    suspects = flagged.where("suspect")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    wanted = suspects.select("sha").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    bodies = texts.select("doc_id", "text").mapInArrow(_normalised, "doc_id long, sha binary, body binary").withColumn("salt", salt)
    # Bytes decide: equal hashes of different texts would make two groups of one hash, which ends the job.
    verified = (
        bodies.join(wanted, ["sha", "salt"], "left_semi")
        .groupBy("sha", "body")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("sha")
        .agg(F.sum("copies").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    )
    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "packet", "seq")
    best = suspects.groupBy("sha").agg(F.min(order).alias("best"))
    groups = best.join(verified, "sha").select(
        "sha",
        "best",
        F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts of one SHA-256"))).alias("group_size"),
    )
    # Written, so that both sides of the join are dealt out anew, and the copies of one text can be split.
    groups, _ = work.store(groups, "groups")
    stays = (F.col("best.packet") == F.col("packet")) & (F.col("best.seq") == F.col("seq"))
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    repeated = suspects.join(groups, "sha").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", stays.alias("kept"), digest, "row_key"
    )
    alone = flagged.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest, "row_key"
    )
    return alone.union(repeated)

"""Near duplicates by SetSketch registers, likelihood and exact verification.

1. Every document's set of word shingles is sketched: for each of ``REGISTERS``
   hash functions the least hash over the set, as an exponential variable cut to
   a power of ``BASE``. Registers of a union are the larger ones of its parts.
   Documents of equal word sequences are one class with one set.
2. Bands of registers make candidates: classes that share a band key are linked
   to the smallest of them (never to each other), and links make clusters.
   With 24 bands of 4 a pair at the threshold of 0.8 misses all with probability
   3e-6, at 0.85 with 2e-8.
3. Within a cluster all pairs are compared in blocks of bounded size: pairs whose
   joint likelihood over the registers leaves no room for the threshold are
   passed over, pairs already connected need no look, all others are verified
   on their full sets. Blocks emit a spanning forest of links, never all pairs.
4. Components of the links; the smallest doc_id of each stays.

A text without words (null, empty, white space) has an empty set and is linked
to nothing. Fewer words than a shingle are one shingle. Rows that repeat a doc_id
with different texts are judged row by row: each has the component of its own text,
and stays if no linked text has a smaller doc_id. Rows without doc_id are linked to
nothing and kept, with a null component. An empty table gives no rows. Texts of any
length are taken whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, connected_components, fresh, slices, workspace
from tidemark.llm.exact_dedup import row_key
from tidemark.llm.memo import Memo

SHINGLE = 5
BANDS, BAND = 24, 4
REGISTERS = BANDS * BAND
BASE = 1.02
#: The largest register value; 2^-33 is the least hash.
TOP = 2000
#: Classes, and shingles of all classes, that a block of a cluster holds on average at most.
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 20
#: Log-likelihood ratio beyond which a pair cannot be a link (odds of 1e8).
SURE = 18.0
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_random = np.random.default_rng(20_14)
FACTORS = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LEFT = (_random.integers(0, 1 << 31, (REGISTERS, 1), dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
RIGHT = _random.integers(0, 1 << 32, (REGISTERS, 1), dtype=np.uint32)

_memo: list[Memo] = []


def _learn(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.ones(len(words), np.int64), np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def word_hashes(texts: list[list[bytes]]) -> list[np.ndarray]:
    if not _memo:
        _memo.append(Memo(_learn, np.uint64, "words"))
    if _memo[0].full():
        _memo[0].clear()
    _memo[0].add(texts)
    return [_memo[0].of(_memo[0].places(words)) for words in texts]


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``SHINGLE`` words; of all words if they are fewer."""
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total += words[i : i + n] * FACTORS[i]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return np.unique(total)


def registers(items: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    high, low = (items >> np.uint64(32)).astype(np.uint32), items.astype(np.uint32)
    for a in range(0, len(items), 1024):
        x = high[a : a + 1024] * LEFT
        x += low[a : a + 1024] ^ RIGHT
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 4294967296.0)
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.int16)


def _split(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case."""
    return raw.translate(LOWER).split()


def _sketched(batches):
    for batch in batches:
        texts = byte_texts(batch["text"])
        for a, b in slices(texts, 1 << 20):
            words = [_split(t) for t in texts[a:b]]
            sets = [shingles(h) for h in word_hashes(words)]
            names = [hashlib.sha256(b" ".join(w)).digest() if w else None for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"][a:b],
                    batch["row_key"][a:b],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "row_key", "n_shingles", "words", "sketch"],
            )


def _bands(batches):
    marks = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        table = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.int16).reshape(-1, REGISTERS)
        keys = np.ascontiguousarray(table).view(np.uint64) ^ marks
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(29)
        owner = pa.array(np.repeat(np.arange(len(table)), BANDS))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), batch["class"].take(owner)], ["band", "class"])


def log_likelihood(more: np.ndarray, less: np.ndarray, equal: np.ndarray, n: np.ndarray, m: np.ndarray, similarity):
    """Of a Jaccard similarity, where of two sets' registers so many are larger, smaller and equal."""
    share = n / (n + m)
    a = np.clip(share - (1 - share) * similarity, 1e-9, 1)
    b = np.clip((1 - share) - share * similarity, 1e-9, 1)
    p, q = (-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE) for x in (a, b))
    return more * np.log(p) + less * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-9, 1))


def may_link(one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the likelihood over the registers leaves room for the threshold."""
    more, less = (one > others).sum(1), (one < others).sum(1)
    equal = REGISTERS - more - less
    room = (equal >= REGISTERS * threshold / 2) & (np.minimum(n, sizes) >= (threshold - 1e-9) * np.maximum(n, sizes))
    at = np.flatnonzero(room)
    grid = np.linspace(0, 1, 41)[:, None]
    parts = (more[at], less[at], equal[at], float(n), sizes[at].astype(float))
    below = log_likelihood(*parts, grid[grid[:, 0] < threshold]).max(0)
    above = log_likelihood(*parts, np.concatenate([[[threshold]], grid[grid[:, 0] >= threshold]])).max(0)
    room[at] = below - above <= SURE
    return room


def _block_links(percent: int):
    """Links of one block, or between two: a spanning forest of what is verified."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(h) for h in word_hashes([_split(t.encode()) for t in rows["text"]])]
        ids, block = rows["class"].to_numpy(np.int64), rows["block"].to_numpy()
        if not sets:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        sizes = np.array([len(s) for s in sets])
        table = np.array([registers(s) for s in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        marked = np.zeros(flat.max() + 1, np.int64)
        label = np.unique(ids, return_inverse=True)[1]
        within = bool((rows["low"] == rows["other"]).all())
        links = []
        for u in range(len(sets) - 1):
            near = np.arange(u + 1, len(sets))
            near = near[(label[near] != label[u]) & (within | (block[near] != block[u]))]
            near = near[may_link(table[u], table[near], sizes[u], sizes[near], percent / 100)] if len(near) else near
            if not len(near):
                continue
            own = flat[starts[u] : starts[u] + sizes[u]]
            marked[own] = 1
            lengths = sizes[near]
            after = np.cumsum(lengths)
            places = np.repeat(starts[near] - after + lengths, lengths) + np.arange(after[-1])
            common = np.add.reduceat(marked[flat[places]], after - lengths)
            marked[own] = 0
            for v in near[100 * common >= percent * (sizes[u] + lengths - common)]:
                if label[v] != label[u]:
                    links.append((ids[u], ids[v]))
                    label[label == label[v]] = label[u]
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return run


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_key, n_shingles, component_id, kept.

    ``row_key`` is ``exact_dedup.row_key(docs)``, by which the row can be found again. Documents are linked when 100 times the intersection of their sets is at
    least ``percent`` times the union.
    """
    spark = docs.sparkSession
    work = workspace(spark, "near-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(docs).alias("row_key"), F.col("text").cast("string").alias("text"))
    sketched, _ = work.store(
        texts.mapInArrow(_sketched, "doc_id long, row_key long, n_shingles long, words binary, sketch binary"), "sketches"
    )
    named = sketched.where("words IS NOT NULL AND doc_id IS NOT NULL")
    # A class has a number of its own, as rows that repeat a doc_id may be of several.
    classes, _ = work.store(
        named.groupBy("words")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.min_by("row_key", F.struct("doc_id", "row_key")).alias("row_key"),
            F.first("sketch").alias("sketch"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    keys = classes.select("class", "sketch").mapInArrow(_bands, "band long, class long")
    least = keys.groupBy("band").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = keys.join(least.select("band", "least"), "band").where("class <> least")
    stars = stars.select(F.col("class").alias("a"), F.col("least").alias("b")).distinct()
    clusters = connected_components(spark, stars, work, "clusters").withColumnRenamed("node", "class")
    located = clusters.join(classes.select("class", "first_id", "row_key", "n_shingles"), "class")
    blocked = (
        located.groupBy("component")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("n_shingles"))
        .select(
            "component",
            F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        )
    )
    members = located.join(blocked, "component").select(
        F.col("first_id").alias("doc_id"), "row_key", "class", "component", "blocks", F.pmod(F.xxhash64("class"), "blocks").cast("int").alias("block")
    )
    pairs = (
        texts.where("text IS NOT NULL")
        .join(members, ["doc_id", "row_key"])
        .withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "class",
            "text",
            "component",
            "block",
            F.least("block", "partner").alias("low"),
            F.greatest("block", "partner").alias("other"),
        )
    )
    links = pairs.groupBy("component", "low", "other").applyInPandas(_block_links(percent), "a long, b long")
    links, _ = work.store(links, "links")
    joined = connected_components(spark, links, work, "components")
    rooted = classes.select("words", "first_id", "class").join(joined.withColumnRenamed("node", "class"), "class", "left")
    rooted, _ = work.store(rooted.select("words", "first_id", F.coalesce("component", "class").alias("root")), "rooted")
    first, _ = work.store(rooted.groupBy("root").agg(F.min("first_id").alias("component")), "first")
    known, _ = work.store(rooted.join(first, "root").select("words", "component"), "known")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketched.select("doc_id", "row_key", "n_shingles", "words")
        .join(known, "words", "left")
        .select("doc_id", "row_key", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows, not doc_ids, are dropped."""
    work = workspace(docs.sparkSession, "near-copies")
    key, doc_id = fresh(docs, "gone_key"), fresh(docs, "gone_id")
    gone = near_duplicates(docs, percent).where("NOT kept").select(F.col("row_key").alias(key), F.col("doc_id").alias(doc_id)).distinct()
    gone, _ = work.store(gone, "gone")
    same = (row_key(docs) == F.col(key)) & (docs["doc_id"].cast("long") == F.col(doc_id))
    return docs.join(gone, same, "left_anti")

"""Token ids of documents as raw payloads in files, with a minimal perfect hash index.

Documents are sorted by doc_id over range partitions and written as blocks; a
block holds documents of one range of ``SPAN`` keys (several blocks if they are
long). Columns of a block row, all read on their own:

``payload``   the ids of all its records, raw little-endian, 16 bits wide where
              the vocabulary allows it, else 32
``ends``      where each record ends in the payload, in ids (64 bits each)
``keys``      each record's doc_id (64 bits each), null ones first
``index``     a minimal perfect hash over the distinct keys: a pilot for each
              bucket, then for each slot a 32-bit fingerprint and the first
              record of the key; a key takes one slot, found in constant time

Spark's Parquet writer carries the blocks, so any store that Spark reaches will
do and a lost task leaves nothing behind. Totals of the range partitions give
every document its place among all ids; there are as many as partitions.

Nulls count as the empty text, which has the end id alone. Rows that repeat a
doc_id are records next to each other, in the order of their texts, found by one
key. Rows without doc_id come first and are not in the index. An empty table
gives files without rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import compress

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import slices
from tidemark.llm.memo import Memo, flat

MODEL = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
#: Keys of one block, and the ids after which a block is closed all the same.
SPAN = 1024
BLOCK_IDS = 1 << 22
#: Chunks that a task keeps the ids of.
MOST_WORDS = 1_000_000
SIGNS = ".,!#$%&*|?;:"
KEYS_PER_BUCKET = 4
BLOCKS = "part int, block int, shard long, first long, before long, n_ids long, width int, nulls int, keys binary, ends binary, index binary, payload binary"


# -- ids ---------------------------------------------------------------------------------


class Encoder:
    """Ids of the tokenizers library, encoding each different chunk of a text once."""

    #: A run of letters, which is one word of the vocabulary's splitting; so is a run of signs after it.
    LETTERS = re.compile("[a-zß-öø-ÿ]+")

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.last = np.zeros(size, bool)  # pieces that end a word
        self.last[[i for piece, i in self.library.get_vocab().items() if piece.endswith("</w>")]] = True
        self.special = re.compile("|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()) or "(?!)", re.IGNORECASE)
        self.units = Memo(self._learn_units, self.dtype, "token ids", MOST_WORDS)
        self.memo = Memo(self._learn, np.int32, "token ids", MOST_WORDS)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _is_word(self, unit: str) -> bool:
        if unit.isascii():
            return unit.isalpha() and unit.islower()
        return self.LETTERS.fullmatch(unit) is not None

    def _learn_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters share a text, where each ends with the only piece that ends a word."""
        lists: list[list[int]] = []
        is_word = [self._is_word(u) for u in units]
        words = list(compress(units, is_word))
        for a in range(0, len(words), 1000):
            some = words[a : a + 1000]
            ids = self._library([" ".join(some)])[0]
            cuts = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(cuts) != len(some):
                raise ValueError("a word did not end once")
            lists += map(ids.__getitem__, map(slice, [0, *cuts[:-1]], cuts))
        others = [u for u, word in zip(units, is_word, strict=True) if not word]
        place = dict(zip(words + others, lists + self._library(others), strict=True))
        return flat([place[u] for u in units], self.dtype)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks as one or two units: a word of letters and its signs, or the chunk itself."""
        units: list[str] = []
        lengths = np.ones(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            word = chunk.rstrip(SIGNS)
            if word != chunk and self._is_word(word):
                units += (word, chunk[len(word) :])
                lengths[i] = 2
            else:
                units.append(chunk)
        return lengths, self.units.take([units])[0]

    def _chunks(self, text: str) -> list[str]:
        """Chunks between spaces and line ends, in lower case where that is the library's."""
        if text.isascii() or _latin1(text):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [i for i, t in enumerate(texts) if self.special.search(t)]
        out = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True))
        chunks = [[] if i in out else self._chunks(t) for i, t in enumerate(texts)]
        if self.memo.full():
            self.memo.clear()
            self.units.clear()
        places = self.memo.take(chunks)
        return [np.array(out[i], self.dtype) if i in out else self.units.of(self.memo.of(p)) for i, p in enumerate(places)]


def _latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# -- index -------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(hashed: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (_mix(hashed ^ _mix(pilots.astype(np.uint64))) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray, records: np.ndarray) -> bytes:
    """Distinct int64 keys and the first record of each."""
    n = len(keys)
    buckets = -(-n // KEYS_PER_BUCKET)
    hashed = _mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    bucket = (hashed >> np.uint64(40)).astype(np.int64) % max(1, buckets)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    starts = np.cumsum(counts) - counts
    free = np.ones(n, bool)
    pilots = np.zeros(buckets, "<u4")
    prints, first = np.zeros(n, "<u4"), np.zeros(n, "<u4")
    for b in np.argsort(-counts, kind="stable"):
        if not counts[b]:
            break
        own = order[starts[b] : starts[b] + counts[b]]
        base = 0
        while True:
            tried = np.arange(base, base + 256)
            slots = _slots(hashed[own][None, :], tried[:, None], n)
            good = free[slots].all(axis=1)
            if len(own) > 1:
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                break
            base += 256
        at = int(np.argmax(good))
        pilots[b] = base + at
        free[slots[at]] = False
        prints[slots[at]] = (hashed[own] >> np.uint64(8)).astype(np.uint32)
        first[slots[at]] = records[own]
    return np.array([n, buckets], "<u4").tobytes() + pilots.tobytes() + prints.tobytes() + first.tobytes()


def find(index: bytes, keys: np.ndarray) -> np.ndarray:
    """The first record of each key, -1 where the fingerprint tells that it is not here."""
    n, buckets = (int(x) for x in np.frombuffer(index, "<u4", 2))
    if not n:
        return np.full(len(keys), -1)
    pilots = np.frombuffer(index, "<u4", buckets, 8)
    prints = np.frombuffer(index, "<u4", n, 8 + 4 * buckets)
    first = np.frombuffer(index, "<u4", n, 8 + 4 * buckets + 4 * n)
    hashed = _mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    slots = _slots(hashed, pilots[(hashed >> np.uint64(40)).astype(np.int64) % buckets], n)
    here = prints[slots] == (hashed >> np.uint64(8)).astype(np.uint32)
    return np.where(here, first[slots].astype(np.int64), -1)


# -- files -------------------------------------------------------------------------------


def _blocks(model: str, end_id: int, span: int, block_ids: int):
    def close(part, block, shard, keys, ids, before, width):
        own = np.array([k for k in keys if k is not None], np.int64)
        nulls = len(keys) - len(own)
        distinct, first = np.unique(own, return_index=True)
        ends = np.cumsum([len(x) for x in ids]).astype("<i8")
        row = {
            "part": part,
            "block": block,
            "shard": shard,
            "first": None if nulls == len(keys) else int(own[0]),
            "before": before,
            "n_ids": int(ends[-1]),
            "width": width,
            "nulls": nulls,
            "keys": own.astype("<i8").tobytes(),
            "ends": ends.tobytes(),
            "index": build_index(distinct, first + nulls),
            "payload": b"".join(x.tobytes() for x in ids),
        }
        return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    def run(batches):
        part, block, shard, keys, ids, held, before = TaskContext.get().partitionId(), 0, None, [], [], 0, 0
        code = encoder(model)
        end = np.array([end_id], code.dtype)
        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in slices(texts, 1 << 20):
                for key, found in zip(doc_ids[a:b], code.encode(texts[a:b]), strict=True):
                    now = None if key is None else key // span
                    if keys and (now != shard or held >= block_ids):
                        yield close(part, block, shard, keys, ids, before, code.width)
                        block, keys, ids, held, before = block + 1, [], [], 0, before + held
                    shard = now
                    keys.append(key)
                    ids.append(np.append(found, end))
                    held += len(ids[-1])
        if keys:
            yield close(part, block, shard, keys, ids, before, code.width)

    return run


_SCHEMA = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("shard", pa.int64()), ("first", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64())]
    + [("width", pa.int32()), ("nulls", pa.int32())]
    + [(name, pa.binary()) for name in ("keys", "ends", "index", "payload")]
)


def write(docs: DataFrame, path: str, model: str = MODEL, end_id: int = END_ID, span: int = SPAN, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents in ascending doc_id order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_blocks(model, end_id, span, block_ids), BLOCKS).write.parquet(path)


def _record(block: dict, at: int) -> np.ndarray:
    ends = np.frombuffer(block["ends"], "<i8")
    start = int(ends[at - 1]) if at else 0
    width = block["width"]
    return np.frombuffer(block["payload"], f"<u{width}", int(ends[at]) - start, start * width)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files, through the index: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the checksum is of the
    ids as little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.parquet(path)
    totals = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # one row a partition
    starts = dict(zip([p for p, _ in totals], np.cumsum([0] + [n for _, n in totals]).tolist(), strict=False))
    return blocks.select("part", "before", "width", "nulls", "keys", "ends", "index", "payload").mapInArrow(
        _documents(starts), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _documents(part_starts: dict[int, int]):
    """The documents of blocks; a block's place is that of its part and what the part holds before it."""

    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                keys = np.frombuffer(block["keys"], "<i8")
                distinct, copies = np.unique(keys, return_counts=True)
                first = find(block["index"], distinct)
                if (first < 0).any():
                    raise ValueError("a key of the block is not in its index")
                at = np.repeat(first, copies) + np.arange(len(keys)) - np.repeat(np.cumsum(copies) - copies, copies)
                at = np.concatenate([np.arange(block["nulls"]), at])
                ids = [None] * block["nulls"] + np.repeat(distinct, copies).tolist()
                ends = np.frombuffer(block["ends"], "<i8")
                starts = np.concatenate([[0], ends[:-1]])
                base = part_starts[block["part"]] + block["before"]
                sums = [zlib.crc32(_record(block, i).astype("<u4").tobytes()) for i in at.tolist()]
                columns = [ids, (base + starts[at]).tolist(), (ends - starts)[at].tolist(), sums]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def lookup(spark: SparkSession, path: str, keys: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id and ids of every record under the distinct non-null keys of ``keys`` (doc_id)."""
    wanted = keys.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    wanted = wanted.withColumn("shard", F.floor(F.col("doc_id") / span).cast("long"))
    blocks = spark.read.parquet(path).join(wanted.select("shard").distinct(), "shard", "left_semi")

    def pick(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        names = asked["doc_id"].to_numpy(np.int64)
        for block in found.to_dict("records"):
            kept = np.frombuffer(block["keys"], "<i8")
            for key, at in zip(names, find(block["index"], names), strict=True):
                while 0 <= at - block["nulls"] < len(kept) and kept[at - block["nulls"]] == key:
                    out.append((key, _record(block, int(at)).astype(np.int32)))
                    at += 1
        return pd.DataFrame(out, columns=["doc_id", "ids"])

    return wanted.groupBy("shard").cogroup(blocks.groupBy("shard")).applyInPandas(pick, "doc_id long, ids array<int>")

"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier (in
a document of smaller doc_id, or before in the same one).

1. Every such string has an anchor, the least hash of the ``GRAM``-byte strings
   in it, so equal strings have equal anchors at equal places; about one place in
   35 is one. Anchors whose hash occurs once in the corpus cannot repeat.
2. The strings that share a repeated anchor form a region of at most 168 bytes.
   Tasks drop regions that they hold twice (all but the first are repeats), and
   the rest meet by anchor in units of bounded size. An anchor with more than
   ``HOT`` places is split: its strings meet by their own hash instead.
3. A unit sorts the suffixes of its regions in two stages: suffixes smaller than
   their successors are sorted directly, all others follow by scanning buckets in
   order. Adjacent common prefixes of ``LENGTH`` bytes or more make groups of equal
   strings, of which the earliest is kept.
4. Repeated stretches go back to their document, are merged, and cut out.

Texts shorter than ``LENGTH`` bytes, empty and null ones lose nothing. Rows that
repeat a document count as one document, each row with the same result; rows of
one doc_id with different texts are in the order of a hash of their texts. Rows
without doc_id come last. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, slices, workspace

LENGTH, GRAM = 100, 32
#: Bytes of text that are anchored together, and of regions in a unit on average.
PART = 1 << 20
UNIT_BYTES = 4 << 20
HOT = 200_000
PLACE_BITS = np.uint64(22)
LAST = (1 << 63) - 1

_random = np.random.default_rng(5)
BYTE_HASH = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = [np.uint64(x) | np.uint64(1) for x in _random.integers(0, 1 << 63, 8, dtype=np.uint64)]


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each place on."""
    h, width, level = BYTE_HASH[data], 1, 0
    while width < size:
        h = h[:-width] * STEP[level] + h[width:]
        h ^= h >> np.uint64(31)
        width, level = width * 2, level + 1
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of ``size`` values from each place on."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Anchors of texts that lie in ``data`` from starts to ends.

    The 40-bit hash of each anchor, its first string's place, and how many
    strings (one byte apart) have this anchor; strings cross no text's end.
    """
    assert len(data) <= 1 << int(PLACE_BITS)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none
    hashes = _gram_hashes(data, GRAM)
    places = np.arange(len(hashes), dtype=np.uint64)
    short = hashes >> np.uint64(24)
    key = _least((short << PLACE_BITS & ~((np.uint64(1) << PLACE_BITS) - np.uint64(1))) | places, LENGTH - GRAM + 1)
    inside = np.zeros(len(key) + 1, np.int32)
    long = ends - starts >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return none, none, none
    place = (key[at] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    opens = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1))
    counts = np.diff(np.append(opens, len(at)))
    return short[place[opens]].astype(np.int64), at[opens], counts


def _parts(raw: list[bytes]):
    """Texts put together in parts of bounded size; every long text alone, in parts that overlap by a string less a byte."""
    done = 0
    for long in [*(i for i, t in enumerate(raw) if len(t) > PART), len(raw)]:
        for a, b in slices(raw[done:long], PART):
            texts = raw[done + a : done + b]
            ends = np.cumsum([len(t) for t in texts])
            starts = np.concatenate([[0], ends[:-1]])
            yield np.arange(done + a, done + b), np.zeros(b - a, np.int64), np.frombuffer(b"".join(texts), np.uint8), starts, ends
        if long < len(raw):
            for c in range(0, max(1, len(raw[long]) - LENGTH + 1), PART):
                piece = raw[long][c : c + PART + LENGTH - 1]
                yield np.array([long]), np.array([c]), np.frombuffer(piece, np.uint8), np.array([0]), np.array([len(piece)])
        done = long + 1


def _anchored(batches):
    for batch in batches:
        raw = byte_texts(batch["text"])
        for owners, bases, data, starts, ends in _parts(raw):
            hashes, at, counts = anchors(data, starts, ends)
            text = np.searchsorted(ends, at, side="right")
            place = (at - starts[text] + bases[text]) << 7 | counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), batch["key"].take(pa.array(owners[text])), pa.array(place)], ["anchor", "key", "place"]
            )


def _packed(batches):
    """Texts on their way to where they are cut, compressed: they are moved twice."""
    compressor = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        bodies = pa.array([compressor.compress(t) if t else None for t in byte_texts(batch["text"])], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["key"], batch["doc_id"], bodies], ["key", "doc_id", "body"])


def _unpacked(column: pa.Array) -> list[bytes]:
    decompressor = zstandard.ZstdDecompressor()
    return [decompressor.decompress(x) if x else b"" for x in column.to_pylist()]


UNIT = "unit long, body binary"


def _chunk(regions: list[tuple]) -> bytes:
    """Regions of one unit, packed: their number, documents, doc_ids, starts and sizes (below 0: to cut), then their bytes."""
    keys, doc_ids, starts, sizes, bodies = zip(*regions, strict=True)
    numbers = [np.array([len(regions)], "<i8"), *(np.array(x, "<i8") for x in (keys, doc_ids, starts)), np.array(sizes, "<i4")]
    return b"".join([*(x.tobytes() for x in numbers), *bodies])


def _unchunked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    keys, doc_ids, starts = (np.frombuffer(raw, "<i8", n, 8 + 8 * n * i) for i in range(3))
    sizes = np.frombuffer(raw, "<i4", n, 8 + 24 * n)
    ends = 8 + 28 * n + np.cumsum(np.maximum(sizes, 0), dtype=np.int64)
    return keys, doc_ids, starts, sizes, [raw[e - max(0, s) : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _regions(units: int):
    """Regions of documents by unit; where a task holds one twice, the later ones as stretches to cut (size < 0)."""

    def flush(held: dict, cut: list):
        compressor = zstandard.ZstdCompressor(level=3)
        by_unit: dict[int, list] = {}
        for (u, r), (d, k, s) in held.items():
            by_unit.setdefault(u, []).append((k, d, s, len(r), r))
        for d, k, s, n in cut:
            by_unit.setdefault(k % units, []).append((k, d, s, -n, b""))
        names, size = list(by_unit), 1000
        for a in range(0, len(names), size):
            some = names[a : a + size]
            bodies = [compressor.compress(_chunk(by_unit.pop(u))) for u in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(bodies, pa.binary())], ["unit", "body"])

    def run(batches):
        held: dict = {}
        cut: list = []
        bytes_held = 0
        for batch in batches:
            columns = (batch[c] for c in ("key", "doc_id", "found"))
            for raw, key, doc_id, found in zip(_unpacked(batch["body"]), *(c.to_pylist() for c in columns), strict=True):
                doc_id = LAST if doc_id is None else doc_id
                for anchor, place, hot in sorted({(f["anchor"], f["place"], f["hot"]) for f in found}):
                    start, count = place >> 7, place & 127
                    steps = range(count) if hot else (0,)
                    for i in steps:
                        region = raw[start + i : start + (i + LENGTH if hot else count + LENGTH - 1)]
                        unit = int.from_bytes(hashlib.blake2b(region, digest_size=6).digest()) if hot else anchor
                        named, now = (unit % units, region), (doc_id, key, start + i)
                        before = held.get(named)
                        if before is None:
                            held[named] = now
                            bytes_held += len(region) + 200
                        elif before != now:
                            held[named] = min(before, now)
                            cut.append((*max(before, now), len(region)))
                if bytes_held > 16 * UNIT_BYTES or len(cut) > 200_000:
                    yield from flush(held, cut)
                    held, cut, bytes_held = {}, [], 0
        if held or cut:
            yield from flush(held, cut)

    return run


# -- the suffix array of one unit ----------------------------------------------------------


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number in their order."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | padded[i : i + len(text)]
    return out


def _direct_sort(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes at ``at`` in order of their first ``depth`` bytes; equal ones stay together.

    Suffixes that agree on all of them are found by hash first, so that only
    different ones are refined, eight bytes at a time.
    """

    def word(places, d):
        return words[np.minimum(places + d, len(words) - 1)]

    steps = range(0, depth, 8)
    hashed = np.zeros(len(at), np.uint64)
    for d in steps:
        hashed = (hashed ^ word(at, d)) * np.uint64(0xD6E8FEB86659FD93)
        hashed ^= hashed >> np.uint64(32)
    by_hash = np.argsort(hashed, kind="stable")
    new = np.ones(len(at), bool)
    new[1:] = hashed[by_hash][1:] != hashed[by_hash][:-1]
    heads = by_hash[new]
    sizes = np.diff(np.append(np.flatnonzero(new), len(at)))
    first = at[heads]
    order = np.argsort(word(first, 0), kind="stable")
    rank = np.zeros(len(order), np.int64)
    key = word(first[order], 0)
    rank[1:] = np.cumsum(key[1:] != key[:-1])
    for d in steps[1:]:
        tied = np.zeros(len(order), bool)
        same = rank[1:] == rank[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        where = np.flatnonzero(tied)
        if not len(where):
            break
        key = word(first[order[where]], d)
        inner = np.lexsort((key, rank[where]))
        order[where] = order[where][inner]
        key = key[inner]
        grow = np.zeros(len(order), np.int64)
        group = rank[where]
        grow[where[1:]] = (group[1:] == group[:-1]) & (key[1:] != key[:-1])
        rank = rank + np.cumsum(grow)
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[order]
    after = np.cumsum(lengths)
    return at[by_hash[np.repeat(starts[order] - after + lengths, lengths) + np.arange(len(at))]]


def suffix_array(text: np.ndarray, words: np.ndarray, wanted: np.ndarray | None = None, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes, by two-stage sorting.

    All of them, or those at ``wanted`` places and, after each, those up to the next
    that is smaller than its successor, from which the others are induced.
    """
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=256))
    last = np.where(step != 0, np.arange(n), n)
    smaller = step[np.minimum.accumulate(last[::-1])[::-1]] > 0  # than the suffix at the next place
    needed = np.ones(n, bool)
    if wanted is not None:
        next_smaller = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
        marks = np.zeros(n + 1, np.int32)
        np.add.at(marks, wanted, 1)
        np.add.at(marks, next_smaller[wanted] + 1, -1)
        needed = np.cumsum(marks[:-1]) > 0
    counts = np.bincount(text[needed], minlength=257)
    begin = np.concatenate([[0], np.cumsum(counts)])
    fill = begin[:256].copy()
    array = np.zeros(int(counts.sum()), np.int64)
    direct = _direct_sort(np.flatnonzero(smaller & needed), words, depth)
    sizes = np.bincount(text[direct], minlength=256)
    array_ends = begin[1:257]
    after = np.cumsum(sizes)
    for c in np.flatnonzero(sizes):  # directly sorted suffixes end each bucket
        array[array_ends[c] - sizes[c] : array_ends[c]] = direct[after[c] - sizes[c] : after[c]]

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~smaller[before] & needed[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        got = np.bincount(first, minlength=256)
        offset = np.cumsum(got) - got
        array[fill[first] + np.arange(len(before)) - offset[first]] = before
        fill[:] = fill + got

    for c in np.flatnonzero(counts[:256]):
        done = begin[c]
        while done < fill[c]:  # what this bucket induces in itself is scanned next
            now = fill[c]
            induce(array[done:now])
            done = now
        induce(array[array_ends[c] - sizes[c] : array_ends[c]])
    return array


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """Stretches of a unit's regions whose strings start earlier elsewhere: key, start, stop."""
    decompressor = zstandard.ZstdDecompressor()
    columns = zip(*(_unchunked(decompressor.decompress(body)) for body in rows["body"]), strict=True)
    *numbers, regions = columns
    names = ("key", "doc_id", "start", "size")
    rows = pd.DataFrame({name: np.concatenate(x) for name, x in zip(names, numbers, strict=True)})
    rows["region"] = [r for some in regions for r in some]
    is_cut = rows["size"].to_numpy() < 0
    done = rows[is_cut]
    out = [(done["key"].to_numpy(), done["start"].to_numpy(), (done["start"] - done["size"]).to_numpy())]
    rows = rows[~is_cut].drop_duplicates(["key", "start", "size"]).sort_values(["doc_id", "key", "start"])
    if len(rows) > 1:
        out.append(_sorted_repeats(rows))
    key, start, stop = (np.concatenate(x) for x in zip(*out, strict=True))
    return pd.DataFrame({"key": key, "start": start, "stop": stop})


def _sorted_repeats(rows: pd.DataFrame):
    sizes = rows["size"].to_numpy(np.int64)
    body = b"\xff".join(rows["region"].tolist()) + b"\xff" * (LENGTH + 8)
    # UTF-8 has no byte above 0xF4, so each byte moves up by one and the end of a region is 0.
    text = np.frombuffer(body, np.uint8) + np.uint8(1)
    begin = np.cumsum(sizes + 1) - sizes - 1
    counts = sizes - LENGTH + 1
    words = _words(text)
    string = np.full(len(text), -1, np.int64)  # number of each string, in order of document and place
    numbers = np.arange(counts.sum())
    region = np.repeat(np.arange(len(sizes)), counts)
    place = numbers - np.repeat(np.cumsum(counts) - counts, counts)
    wanted = begin[region] + place
    string[wanted] = numbers
    array = suffix_array(text, words, wanted)
    ordered = array[string[array] >= 0]
    same = np.flatnonzero(np.ones(len(ordered) - 1, bool))
    for d in [*range(0, LENGTH - 7, 8), LENGTH - 8]:  # adjacent common prefixes
        same = same[words[ordered[same] + d] == words[ordered[same + 1] + d]]
    new = np.ones(len(ordered), bool)
    new[same + 1] = False
    named = string[ordered]
    first = np.minimum.reduceat(named, np.flatnonzero(new))
    repeated = np.sort(named[named != first[np.cumsum(new) - 1]])
    if not len(repeated):
        none = np.zeros(0, np.int64)
        return none, none, none
    opens = np.flatnonzero((np.diff(repeated, prepend=-2) != 1) | (np.diff(region[repeated], prepend=-1) != 0))
    closes = np.append(opens[1:], len(repeated)) - 1
    own = region[repeated[opens]]
    keys, starts = rows["key"].to_numpy(), rows["start"].to_numpy()
    return keys[own], starts[own] + place[repeated[opens]], starts[own] + place[repeated[closes]] + LENGTH


def _cut(batches):
    """Documents without their repeated stretches."""
    for batch in batches:
        rows = []
        for raw, found in zip(_unpacked(batch["body"]), batch["found"].to_pylist(), strict=True):
            kept, at, spans, removed = [], 0, 0, 0
            stop = -1
            for f in sorted((f["start"], f["stop"]) for f in found or ()):
                if f[0] > stop:
                    spans += 1
                    kept.append(raw[at : f[0]])
                    removed += f[1] - f[0]
                    stop = f[1]
                elif f[1] > stop:
                    removed += f[1] - stop
                    stop = f[1]
                at = stop
            kept.append(raw[at:])
            rows.append((len(raw), removed, spans, b"".join(kept)))
        size, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        arrays = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in (size, removed, spans)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes"])


def without_repeats(docs: DataFrame, unit_bytes: int = UNIT_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_bytes of every row of ``docs``."""
    spark = docs.sparkSession
    work = workspace(spark, "suffix-dedup")
    texts = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    # Written, so that texts are anchored once, and both sides of the join are dealt out anew and can be split.
    places, _ = work.store(texts.select("key", "text").mapInArrow(_anchored, "anchor long, key long, place long"), "places")
    repeated = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated, _ = work.store(repeated.select("anchor", (F.col("n") > hot).alias("hot")), "anchors")
    # Written, so that the shuffles up to here can go before the texts are moved.
    found, seen = work.store(
        places.join(repeated, "anchor"),
        "repeated",
        measures=[F.coalesce(F.sum(F.expr("place & 127") + LENGTH), F.lit(0)).alias("bytes")],
    )
    units = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-seen["bytes"] // unit_bytes))
    by_document = found.groupBy("key").agg(F.collect_list(F.struct("anchor", "place", "hot")).alias("found"))
    bodies = texts.mapInArrow(_packed, "key long, doc_id long, body binary")
    regions = bodies.join(by_document, "key").mapInArrow(_regions(units), UNIT)
    stretches = regions.groupBy("unit").applyInPandas(_repeats, "key long, start long, stop long")
    cuts = stretches.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    rows = bodies.join(cuts, "key", "left").select("doc_id", "body", "found")
    return rows.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary")

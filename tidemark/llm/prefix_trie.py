"""The prefix trie of conversations, by collapse of whole sequences.

1. Turns are sorted by conversation and turn over range partitions, numbered, and
   reduced to a digest of role and text and a number of words; texts move once.
2. Each conversation is rebuilt: the first turns of its family's first one, then its own.
3. A prefix is named by its length and the sum of its turns' hashes, each with its
   place: running sums give every prefix of every conversation in one pass. Sums of
   parts of a conversation can be added, so the longest one is split like others
   (``running``); hashes are two of 64 bits, from 128 bits of SHA-256 of each turn.
4. Identical rebuilt conversations collapse into one weighted sequence, with the
   smallest of them as its representative, and the list of them as its ends.
   Sequences that are a proper prefix of others drop out by an anti-join; the
   rest are the leaves. Only representatives' prefixes are aggregated, with weights.
5. A subtree's saved words are its members' words, less each distinct node's words
   once. A node is counted by its smallest member: from the depth on at which a
   sequence becomes the smallest member of its nodes, they are its own.

Long lists of ends are never gathered: they are sorted over range partitions,
packed into texts of bounded size, and hashed one text after the other.

Null roles and texts are empty. Turns of equal number are in the order of role and
text; of equal rows each is a turn. Rows without conv_id are left out. An empty
table gives no rows, not even a root. Texts of any length are read once, by the
task that numbers them. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_texts, workspace
from tidemark.sources.workspace import Workspace

#: Conversations of a family share the opening of the first of them, of this many turns less one at most.
FAMILY, OPENING = 20, 4
#: Bytes of one packed text of ends.
PACKED = 1 << 18
EMPTY = hashlib.sha256(b"").hexdigest()


# -- running sums over groups that may span tasks ------------------------------------------


def _local_sums(by: str, values: list[str], others: list[str], prepare):
    """Sums within each group so far, as far as this task sees it, and totals of its first and last group."""

    def run(batches):
        part = TaskContext.get().partitionId()
        group, carried, first = None, np.zeros(len(values), np.int64), None
        for batch in batches:
            if not len(batch):
                continue
            columns = prepare(batch) if prepare else {c: batch[c] for c in batch.schema.names}
            groups = np.asarray(columns[by], np.int64)
            table = np.column_stack([np.asarray(columns[v], np.int64) for v in values])
            sums = np.cumsum(table, axis=0)
            new = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
            base = np.zeros_like(table[new])
            base[1:] = -sums[new[1:] - 1]
            if group == groups[0]:
                base[0] = carried
            sums += np.repeat(base, np.diff(np.append(new, len(groups))), axis=0)
            if first is None and group is not None and group != groups[0]:
                first = (group, carried)
            if first is None and len(new) > 1:
                first = (int(groups[0]), sums[new[1] - 1])
            group, carried = int(groups[-1]), sums[-1]
            out = {by: pa.array(groups)} | {c: columns[c] for c in others} | {v: columns[v] for v in values}
            out |= {f"{v}_sum": pa.array(sums[:, i]) for i, v in enumerate(values)}
            yield _with_part(out, part, False)
        if group is not None:
            ends = [first, (group, carried)] if first else [(group, carried)]
            out = {by: pa.array([g for g, _ in ends], pa.int64())}
            out |= {c: pa.nulls(len(ends), pa.int64()) for c in [*others, *values]}
            out |= {f"{v}_sum": pa.array([int(s[i]) for _, s in ends], pa.int64()) for i, v in enumerate(values)}
            yield _with_part(out, part, True)

    return run


def _with_part(columns: dict, part: int, total: bool) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    columns = {c: x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for c, x in columns.items()}
    return pa.RecordBatch.from_pydict(columns | {"part": pa.array(np.full(size, part), pa.int64()), "total": pa.array([total] * size)})


def _add(by: str, values: list[str], offsets: dict[int, tuple[int, np.ndarray]]):
    """What earlier tasks saw of the group that each task began in; sums before each row as well."""

    def run(batches):
        for batch in batches:
            groups, parts = np.asarray(batch[by]), np.asarray(batch["part"])
            sums = [np.array(batch[f"{v}_sum"]) for v in values]
            for part in np.unique(parts).tolist():
                if part in offsets:
                    group, offset = offsets[part]
                    here = (parts == part) & (groups == group)
                    for i, own in enumerate(sums):
                        own[here] += offset[i]
            columns = {c: batch[c] for c in batch.schema.names if c not in ("part", "total")}
            columns |= {f"{v}_sum": pa.array(s) for v, s in zip(values, sums, strict=True)}
            columns |= {f"{v}_before": pa.array(s - np.asarray(batch[v])) for v, s in zip(values, sums, strict=True)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def running(rows: DataFrame, by: str, order: list, values: list[str], work: Workspace, name: str, others=(), prepare=None) -> DataFrame:
    """``rows`` (long columns) with, for each value v, its sum within ``by`` up to and with each row: v_sum, and without it: v_before.

    Sums wrap at 64 bits. Rows are sorted by range, so one group may fill many
    tasks; each tells the totals of the first and last group it saw, two rows a
    task, from which the driver derives what to add to the first group of each.
    ``prepare`` makes the columns from a sorted batch; without it they are there.
    """
    others = list(others)
    sorted_rows = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    kept = [by, *others, *values, *(f"{v}_sum" for v in values)]
    schema = ", ".join(f"{c} long" for c in kept)
    found, _ = work.store(sorted_rows.mapInArrow(_local_sums(by, values, others, prepare), f"{schema}, part long, total boolean"), name)
    totals: dict[int, list] = {}
    for r in found.where("total").collect():  # two rows a task at most
        totals.setdefault(r["part"], []).append((r[by], np.array([r[f"{v}_sum"] for v in values], np.int64)))
    offsets, open_group, so_far = {}, None, None
    for part in sorted(totals):
        ends = sorted(totals[part], key=lambda x: x[0])
        if ends[0][0] == open_group:
            offsets[part] = (open_group, so_far)
        if len(ends) == 1 and ends[0][0] == open_group:
            so_far = so_far + ends[0][1]
        else:
            open_group, so_far = ends[-1]
    before = ", ".join(f"{v}_before long" for v in values)
    return found.where("not total").mapInArrow(_add(by, values, offsets), f"{schema}, {before}")


# -- turns -----------------------------------------------------------------------------------


def _digests(batch: pa.RecordBatch) -> dict:
    """Two hashes of role and text, and the words of the text."""
    roles, texts = byte_texts(batch["role"]), byte_texts(batch["text"])
    raw = b"".join(hashlib.sha256(b"%d:" % len(r) + r + t).digest()[:16] for r, t in zip(roles, texts, strict=True))
    hashes = np.frombuffer(raw, "<i8").reshape(-1, 2)
    return {
        "conv_id": batch["conv_id"],
        "h1": pa.array(hashes[:, 0]),
        "h2": pa.array(hashes[:, 1]),
        "words": pa.array([len(t.split()) for t in texts], pa.int64()),
        "one": pa.array(np.ones(len(batch), np.int64)),
    }


def numbered_turns(conversations: DataFrame, work: Workspace) -> DataFrame:
    """conv_id, place (from 1), h1, h2 and words of every turn."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # Equal rows in their order of reading, so that ranges can part them too.
        F.monotonically_increasing_id().alias("read"),
    )
    order = [F.asc_nulls_first("turn"), "role", "text", "read"]
    turns = running(rows, "conv_id", order, ["one"], work, "turns", ["h1", "h2", "words"], _digests)
    return turns.select("conv_id", F.col("one_sum").alias("place"), "h1", "h2", "words")


def rebuilt(turns: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and every conversation's rebuilt length.

    conv_id, place, length, h1, h2, words; conv_id, length.
    """
    lengths, _ = work.store(turns.groupBy("conv_id").agg(F.max("place").alias("own")), "lengths")
    wanted = lengths.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).alias("opening"),
    )
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    shared = F.least("opening", F.coalesce("base_own", F.lit(0)))
    length = F.col("shared") + F.greatest(F.col("own") - F.col("opening"), F.lit(0))
    meta = wanted.join(bases, "base", "left").withColumn("shared", shared).withColumn("length", length)
    meta, _ = work.store(meta.select("conv_id", "base", "opening", "shared", "length"), "rebuilt")
    openings = turns.where((F.col("place") < OPENING) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    taken = meta.join(openings, "base").where("place <= shared").select("conv_id", "place", "length", "h1", "h2", "words")
    own = turns.join(meta.where("length > shared"), "conv_id").where("place > opening")
    own = own.select("conv_id", (F.col("place") - F.col("opening") + F.col("shared")).alias("place"), "length", "h1", "h2", "words")
    return taken.union(own), meta.select("conv_id", "length")


# -- ends ------------------------------------------------------------------------------------

KEY = ["depth", "k1", "k2"]


def _packed(batches):
    """Runs of sorted ids of one sequence as texts of bounded size."""
    key, ids, size = None, [], 0

    def close():
        columns = [pa.array([x], pa.int64()) for x in (*key, ids[0])] + [pa.array([",".join(map(str, ids))])]
        return pa.RecordBatch.from_arrays(columns, [*KEY, "first", "packed"])

    for batch in batches:
        for *now, conv_id in zip(*(batch[c].to_pylist() for c in [*KEY, "conv_id"]), strict=True):
            if ids and (now != key or size >= PACKED):
                yield close()
                ids, size = [], 0
            key = now
            ids.append(conv_id)
            size += len(str(conv_id)) + 1
    if ids:
        yield close()


def _hashed(batches):
    """Of texts sorted by sequence and first id: one hash a sequence, text after text."""
    key, state = None, None

    def close():
        columns = [pa.array([x], pa.int64()) for x in key] + [pa.array([state.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, [*KEY, "ends_sha256"])

    for batch in batches:
        for *now, packed in zip(*(batch[c].to_pylist() for c in [*KEY, "packed"]), strict=True):
            if now == key:
                state.update(b",")
            else:
                if key is not None:
                    yield close()
                key, state = now, hashlib.sha256()
            state.update(packed.encode())
    if key is not None:
        yield close()


def end_hashes(ends: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's conv_ids in ascending order, comma-joined: depth, k1, k2, ends_sha256."""
    order = [*KEY, "conv_id"]
    schema = "depth long, k1 long, k2 long"
    packed = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed, f"{schema}, first long, packed string")
    gathered = packed.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return gathered.mapInArrow(_hashed, f"{schema}, ends_sha256 string")


# -- trie ------------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the rebuilt ``conversations`` (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    work = workspace(conversations.sparkSession, "prefix-trie")
    turns = numbered_turns(conversations, work)
    rows, lengths = rebuilt(turns, work)
    hashed = rows.withColumns({k: F.xxhash64(F.lit(k), "place", "h1", "h2") for k in ("f1", "f2")})
    prefixes = running(hashed, "conv_id", ["place"], ["f1", "f2", "words"], work, "prefixes", ["place", "length"])
    prefixes = prefixes.select(
        "conv_id",
        F.col("place").alias("depth"),
        "length",
        F.col("f1_sum").alias("k1"),
        F.col("f2_sum").alias("k2"),
        F.col("f1_before").alias("p1"),
        F.col("f2_before").alias("p2"),
        "words",
        F.col("words_before").alias("before"),
        F.col("words_sum").alias("upto"),
    )
    zero = F.lit(0).cast("long")
    ended = prefixes.where("depth = length").select("conv_id", *KEY, "upto")
    turnless = lengths.where("length = 0").select("conv_id", *[zero.alias(c) for c in [*KEY, "upto"]])
    ends, _ = work.store(ended.union(turnless), "ends")

    # Identical conversations are one sequence, named by the smallest of them.
    sequences, _ = work.store(
        ends.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("upto").alias("whole")),
        "sequences",
    )
    named = sequences.select("conv_id", "weight", "whole")
    columns = ["conv_id", *KEY, "p1", "p2", "words", "before", "weight", "whole"]
    roots = named.select("conv_id", *[zero.alias(c) for c in KEY], *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], zero.alias("words"), zero.alias("before"), "weight", "whole")
    weighted, _ = work.store(prefixes.join(named, "conv_id").select(columns).union(roots.select(columns)), "weighted")
    nodes, _ = work.store(
        weighted.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.min("p1").alias("p1"),
            F.min("p2").alias("p2"),
            F.min("before").alias("before"),
            F.sum(F.col("weight") * (F.col("whole") - F.col("before"))).alias("all_words"),
        ),
        "nodes",
    )

    # Sequences with a child are proper prefixes of others; the rest are leaves.
    above = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children, _ = work.store(above.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children")), "children")
    leaves = sequences.join(children, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("from_depth"), F.min_by("before", "depth").alias("from_before"))
    owned, _ = work.store(named.select("conv_id").join(leaves, "conv_id", "left").join(owners, "conv_id", "left"), "owned")
    once = (
        F.when(F.col("from_depth").isNull(), zero)
        .when(F.col("depth") >= F.col("from_depth"), F.col("whole") - F.col("before"))
        .otherwise(F.col("whole") - F.col("from_before"))
    )
    below = (
        weighted.join(owned, "conv_id")
        .groupBy(*KEY)
        .agg(F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(once).alias("own_words"))
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, ["depth", "p1", "p2"], "left")
        .join(below, KEY)
        .join(children, KEY, "left")
        .join(end_hashes(ends), KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            (F.col("all_words") - F.col("own_words")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )

"""MERGE as DataFrame operators: each returns the next state of a keyed table.

Target and source hold one row per key, so no key can be hot in these joins. A
source that repeats a key is refused while the plan runs. ``*_changes`` label every
row of the next state, in the same pass, with what the merge did to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.conditions import any_changed

#: What a merge did to a row, in the column ``CHANGE``.
CHANGE = "_change"
INSERTED, UPDATED, DEACTIVATED, REACTIVATED, SAME = "inserted", "updated", "deactivated", "reactivated", "same"
CHANGES = (INSERTED, UPDATED, DEACTIVATED, REACTIVATED, SAME)


def change_counts() -> list[Column]:
    """Rows of each kind of change, in one pass."""
    return [F.count_if(F.col(CHANGE) == kind).alias(kind) for kind in CHANGES]


def _packed(rows: DataFrame, key: str, columns: Sequence[str], name: str) -> DataFrame:
    return rows.select(key, F.struct(*columns).alias(name))


def _like(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in the target's order and types."""
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def _new_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows as ``new`` beside their key; a repeated key ends the job.

    The copies are counted in the partitions and order that the merge join needs
    anyway, so the check moves nothing.
    """
    columns = target.columns
    copies = F.count(F.lit(1)).over(Window.partitionBy(key))
    counted = _like(source, target).withColumn("_copies", copies)
    message = F.concat(F.lit(f"the source repeats {key} "), F.col(key).cast("string"))
    repeated = (F.col("_copies") > 1) & F.col(key).isNotNull()
    new = F.when(repeated, F.raise_error(message)).otherwise(F.struct(*columns))
    return counted.select(key, new.alias("new"))


def _source_wins(compare: Sequence[str]) -> Column:
    """Insert when there is no old row; replace only when a compared column changed."""
    found = F.col("new").isNotNull()
    return found & (F.col("old").isNull() | any_changed("old", "new", compare))


def _survivor(compare: Sequence[str]) -> Column:
    return F.when(_source_wins(compare), F.col("new")).otherwise(F.col("old"))


def _label(old: Column, replaced: Column, was_active: Column | None = None, is_active: Column | None = None) -> Column:
    """The change of a row that was ``old``, if ``replaced`` says whether another took its place."""
    kind = F.when(old.isNull(), F.lit(INSERTED))
    if is_active is not None:
        kind = kind.when(was_active & ~is_active, F.lit(DEACTIVATED)).when(~was_active & is_active, F.lit(REACTIVATED))
    return kind.when(replaced, F.lit(UPDATED)).otherwise(F.lit(SAME)).alias(CHANGE)


def incremental_changes(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compare: Sequence[str],
    broadcast_source: bool = False,
) -> DataFrame:
    """:func:`merge_incremental` with the label of every row."""
    old = _packed(target, key, target.columns, "old")
    new = _new_rows(source, target, key)
    label = _label(F.col("old"), _source_wins(compare))
    if not broadcast_source:
        merged = old.join(new, key, "full_outer").select(_survivor(compare).alias("row"), label)
        return merged.select("row.*", CHANGE)

    rewritten = old.join(F.broadcast(new), key, "left").select(_survivor(compare).alias("row"), label)
    known = target.select(key).join(F.broadcast(new.select(key)), key, "left_semi")
    added = new.join(known, key, "left_anti").select(F.col("new").alias("row"), F.lit(INSERTED).alias(CHANGE))
    return rewritten.unionByName(added).select("row.*", CHANGE)


def merge_incremental(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compare: Sequence[str],
    broadcast_source: bool = False,
) -> DataFrame:
    """Upsert: changed rows are replaced whole, unchanged rows keep their old
    lineage, new rows are added, and rows missing from the source stay.

    ``broadcast_source`` is for callers who measured the source and found it
    small: the target is then rewritten without a shuffle.
    """
    return incremental_changes(target, source, key, compare, broadcast_source).drop(CHANGE)


def snapshot_changes(
    target: DataFrame,
    source: DataFrame,
    snapshot_ids: DataFrame,
    key: str,
    compare: Sequence[str],
) -> DataFrame:
    """:func:`merge_snapshot` with the label of every row."""
    columns = target.columns
    present = (
        snapshot_ids.select(key).distinct().withColumn("_present", F.lit(True))
    )
    old = _packed(target, key, columns, "old").join(present, key, "left")
    unlisted = F.concat(F.lit(f"the snapshot does not list {key} "), F.col(key).cast("string"))
    new = _new_rows(source, target, key).join(present, key, "left")
    new = new.select(
        key, F.when(F.col("_present").isNull(), F.raise_error(unlisted)).otherwise(F.col("new")).alias("new")
    )
    missing = F.col("new").isNull() & F.col("_present").isNull()
    merged = old.join(new, key, "full_outer").select(
        "old", _survivor(compare).alias("row"), missing.alias("_missing"), _source_wins(compare).alias("_wins")
    )
    active = F.when(F.col("_missing"), F.lit(False)).otherwise(F.col("row.is_active"))
    return merged.select(
        *[
            (active if name == "is_active" else F.col(f"row.{name}")).alias(name)
            for name in columns
        ],
        _label(F.col("old"), F.col("_wins"), F.col("old.is_active"), active),
    )


def merge_snapshot(
    target: DataFrame,
    source: DataFrame,
    snapshot_ids: DataFrame,
    key: str,
    compare: Sequence[str],
) -> DataFrame:
    """Upsert plus soft delete, in one pass over the target.

    ``snapshot_ids`` are the keys of every row in the snapshot, rejected rows
    included, in any multiplicity; a source key that is not among them ends the
    job. Target rows whose key is not among them become inactive and are otherwise
    unchanged.
    """
    return snapshot_changes(target, source, snapshot_ids, key, compare).drop(CHANGE)


def folded_changes(
    target: DataFrame,
    source: DataFrame,
    key: str,
    compare: Sequence[str],
    number: str,
    listed: DataFrame | None = None,
    deleting: Sequence[bool] = (),
) -> DataFrame:
    """The merges of several deliveries, one after the other, in one pass; labelled like the others.

    ``source`` holds the rows of all deliveries, told apart by the column
    ``number`` (from 0, in order of arrival), each key at most once in each. With
    ``listed`` (key and number of every row, rejected ones included) they are snapshots: a delivery
    whose flag in ``deleting`` is set deactivates what it does not list. Each
    key's deliveries are folded over its old row, as many steps as deliveries
    name it; the label compares the last state with the first.
    """
    columns = target.columns
    snapshots = listed is not None
    row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])
    steps = source.select(F.col(key).cast(target.schema[key].dataType).alias(key), F.col(number).alias("no"), row.alias("row"))
    if snapshots:
        # A key that is only listed is a step without a row.
        known = listed.where(F.col(key).isNotNull()).select(key, F.col(number).alias("no")).distinct()
        steps = known.join(steps, [key, "no"], "left").select(key, "no", "row")
    steps = steps.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("no", "row"))).alias("steps"))
    merged = _packed(target, key, columns, "old").join(steps, key, "full_outer")

    # Of the deliveries before each, how many delete what they do not list.
    before = [0]
    for flag in deleting:
        before.append(before[-1] + bool(flag))
    deletes = F.array(*[F.lit(n) for n in before])

    def without(state: Column, seen: Column, until: Column) -> Column:
        """The row after the deliveries between ``seen`` and ``until`` did not list it."""
        if not snapshots:
            return state
        gone = (F.get(deletes, until) > F.get(deletes, seen + 1)) & state.isNotNull()
        inactive = F.struct(*[(F.lit(False) if name == "is_active" else state[name]).alias(name) for name in columns])
        return F.when(gone, inactive).otherwise(state)

    def step(state: Column, now: Column) -> Column:
        old = without(state["row"], state["seen"], now["no"])
        differs = F.lit(False)
        for name in compare:
            differs = differs | ~old[name].eqNullSafe(now["row"][name])
        wins = now["row"].isNotNull() & (old.isNull() | differs)
        return F.struct(F.when(wins, now["row"]).otherwise(old).alias("row"), now["no"].alias("seen"))

    start = F.struct(F.col("old").alias("row"), F.lit(-1).alias("seen"))
    last = F.when(F.col("steps").isNull(), start).otherwise(F.aggregate("steps", start, step))
    state = merged.select("old", last.alias("last"))
    state = state.select("old", without(F.col("last.row"), F.col("last.seen"), F.lit(len(before) - 1)).alias("row"))
    state = state.where(F.col("row").isNotNull())  # listed, but never valid
    label = _label(
        F.col("old"),
        ~F.col("row").eqNullSafe(F.col("old")),
        F.col("old.is_active") if snapshots else None,
        F.col("row.is_active") if snapshots else None,
    )
    return state.select("row.*", label)


def unchanged_slices(target: DataFrame, source: DataFrame, slice_of: Column, key: str, compare: Sequence[str], rejected: DataFrame) -> DataFrame:
    """Slices of a snapshot target in which a snapshot changes nothing: slice, n_rows.

    ``rejected`` are the keys that the snapshot lists without a valid row. The
    others' active rows must be the snapshot's rows: both are summed up by slice, as
    their number and two sums of hashes, so nothing but sums is moved.
    """

    def prints(rows: DataFrame, counted: Column, names: list[str]) -> DataFrame:
        values = [F.col(key), *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in compare]]
        hashes = [F.when(counted, F.xxhash64(F.lit(seed), *values)).cast("decimal(38,0)") for seed in ("first", "second")]
        sums = [F.coalesce(F.sum(h), F.lit(0)).alias(n) for h, n in zip(hashes, names[1:], strict=True)]
        return rows.groupBy(slice_of.alias("slice")).agg(F.count(F.lit(1)).alias(names[0] + "_rows"), F.count_if(counted).alias(names[0]), *sums)

    old = target.select(key, *compare).join(rejected.select(key).distinct().withColumn("_rejected", F.lit(True)), key, "left")
    old = prints(old, F.col("is_active") & F.col("_rejected").isNull(), ["n", "h1", "h2"])
    new = prints(_like(source.select(key, *compare), target.select(key, *compare)), F.lit(True), ["m", "g1", "g2"])
    both = old.join(new, "slice", "left").na.fill(0, ["m"])
    same = (F.col("n") == F.col("m")) & (F.col("h1") == F.coalesce("g1", F.lit(0))) & (F.col("h2") == F.coalesce("g2", F.lit(0)))
    return both.where(same).select("slice", F.col("n_rows"))


def soft_delete_missing(target: DataFrame, snapshot_ids: DataFrame, key: str) -> DataFrame:
    """Only the soft delete: mark target rows whose key is not in the snapshot."""
    present = snapshot_ids.select(key).distinct().withColumn("_present", F.lit(True))
    gone = F.col("_present").isNull()
    active = F.when(gone, F.lit(False)).otherwise(F.col("is_active"))
    return target.join(present, key, "left").select(
        *[(active if name == "is_active" else F.col(name)).alias(name) for name in target.columns]
    )


def missing_keys(target: DataFrame, snapshot_ids: DataFrame, key: str) -> DataFrame:
    """Keys of target rows that are absent from the snapshot."""
    return target.select(key).join(snapshot_ids.select(key).distinct(), key, "left_anti")

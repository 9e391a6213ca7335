"""Entity batches and the full refresh.

Any number of sources of one entity are one run: they are read once, named by
content, decided upon in bulk, and validated, quarantined and merged together, each
as a batch of its own. The number of Spark jobs does not depend on that of the sources.

Every stage can be repeated: publishing and quarantine replace a batch's own
partition, silver merges are idempotent and become visible
with one commit. A batch that fails stays at ``BRONZE_WRITTEN`` and resumes there.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import ENTITIES, Entity
from tidemark.operators.control import BRONZE_WRITTEN, SUCCESS, plan_files
from tidemark.operators.merge import (
    CHANGE,
    CHANGES,
    INSERTED,
    SAME,
    folded_changes,
    incremental_changes,
    missing_keys,
    snapshot_changes,
    unchanged_slices,
)
from tidemark.operators.quality import (
    MOST_FILTERED,
    batch_counts,
    error_counts,
    invalid_rows,
    repeated_keys,
    valid_rows,
    validate,
)
from tidemark.operators.quarantine import not_yet_quarantined
from tidemark.operators.standardize import standardize
from tidemark.plans.sales_state import SalesState, changed_items, changed_orders
from tidemark.session import tuned
from tidemark.sources import files
from tidemark.sources.control_log import read_events, record_states
from tidemark.sources.staging import Staging
from tidemark.sources.tables import KeyedTable, ReportSet, append, read_batch, replace_batch
from tidemark.sources.workspace import Workspace

logger = logging.getLogger(__name__)

REPORTS = ("daily_sales", "product_performance", "category_performance", "customer_metrics")

# A side of a join is broadcast only if it was measured and is at most this large:
# keys of 4 to 8 bytes by their number, entity rows by their number and their texts.
BROADCAST_KEYS = 1_000_000
BROADCAST_ROWS = 100_000
BROADCAST_TEXT_BYTES = 32 << 20


@dataclass(frozen=True)
class Layout:
    """Where the tables of one lake live."""

    root: str

    def bronze(self, entity: Entity) -> str:
        return f"{self.root}/bronze/{entity.name}"

    def silver(self, entity: Entity) -> str:
        return f"{self.root}/silver/{entity.name}"

    def quarantine(self, entity: Entity) -> str:
        return f"{self.root}/quarantine/{entity.name}"

    @property
    def control(self) -> str:
        return f"{self.root}/control/processed_files"

    @property
    def batch_counts(self) -> str:
        return f"{self.root}/control/batch_counts"

    @property
    def error_counts(self) -> str:
        return f"{self.root}/control/error_counts"

    @property
    def change_counts(self) -> str:
        return f"{self.root}/control/change_counts"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def state(self) -> str:
        return f"{self.root}/state"


@dataclass(frozen=True)
class Options:
    """Job switches; the defaults are the documented behaviour."""

    strict: bool = False  # fail on values that do not parse
    check_header: bool = True  # fail on headers that disagree with the contract
    null_safe_quarantine: bool = True  # a retried batch adds no keyless rows again
    guard_unkeyed: bool = False  # no soft delete if the snapshot has unreadable keys
    max_missing_fraction: float | None = None  # fail if a snapshot would delete more
    keep_versions: int = 3  # states of a silver table that stay on disk, the current one included
    keep_for: timedelta = timedelta(0)  # and how long a replaced state stays at least


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    skipped: bool
    total_rows: int = 0
    valid_rows: int = 0
    invalid_rows: int = 0
    changes: Mapping[str, int] = field(default_factory=dict)  # of the run that merged it


@dataclass(frozen=True)
class Delivery:
    """One source and what is to be done with it."""

    source: str
    file_hash: str
    batch_id: str
    action: str  # run, resume or skip

    @property
    def event(self) -> tuple[str, str, str]:
        return self.source, self.file_hash, self.batch_id


class SuspiciousSnapshot(RuntimeError):
    """A snapshot that would soft-delete more rows than allowed."""


def decide(spark: SparkSession, entity: Entity, hashes: Mapping[str, str], layout: Layout) -> list[Delivery]:
    """What to do with each source (source -> content hash), in bulk.

    The batch id follows from entity and content, so a crash between the bronze write
    and its event leaves nothing behind that the retry would not replace. Of
    sources of equal content the first counts.
    """
    named = [(entity.name, source, file_hash) for source, file_hash in hashes.items()]
    files_found = spark.createDataFrame(named, "entity string, source_file string, file_hash string")
    events = read_events(spark, layout.control).where(F.col("entity") == entity.name)
    planned = {row["source_file"]: row for row in plan_files(files_found, events).collect()}  # one row a source
    deliveries, seen = [], set()
    for source, file_hash in hashes.items():
        row = planned[source]
        if row["action"] == "unknown":
            raise ValueError(f"unknown file state {row['status']!r} of {source}")
        action = "skip" if file_hash in seen else row["action"]
        seen.add(file_hash)
        deliveries.append(Delivery(source, file_hash, row["batch_id"] or f"{entity.name}-{file_hash[:32]}", action))
    return deliveries


def open_batches(
    spark: SparkSession, entity: Entity, sources: Sequence[str], layout: Layout, options: Options
) -> list[Delivery]:
    """Bring sources into bronze unless that already happened, with one scan of them."""
    with Staging(spark, layout.bronze(entity)) as staging:
        hashes = dict(zip(sources, staging.take(sources, entity, options.check_header), strict=True))
        deliveries = decide(spark, entity, hashes, layout)
        new = [d for d in deliveries if d.action == "run"]
        for delivery in new:
            staging.publish(sources.index(delivery.source), delivery.batch_id)
    if new:
        record_states(spark, layout.control, entity.name, [d.event for d in new], status=BRONZE_WRITTEN)
    return deliveries


def load_quarantine(
    spark: SparkSession,
    invalid: DataFrame,
    path: str,
    key: str,
    batch_ids: Sequence[str],
    null_safe: bool = True,
) -> None:
    """Store the rejected rows of some batches.

    The batches' own partitions are replaced, so a retry after half a write ends with
    every copy. With plain equality (``null_safe=False``) rows are appended unless
    their key is stored, and keyless rows are added again.
    """
    if null_safe:
        replace_batch(invalid, path)
        return
    stored_names = set(files.child_names(spark, path))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in invalid.schema)
    known = [f"{path}/batch_id={b}" for b in batch_ids if f"batch_id={b}" in stored_names]
    if known:
        stored = spark.read.schema(schema).option("basePath", path).parquet(*known)
        invalid = not_yet_quarantined(invalid, stored, key, null_safe=False)
    append(invalid, path, "batch_id")


def _first_load(table: KeyedTable, source: DataFrame, batch_id: str) -> dict[str, int]:
    return table.commit_changes(source.withColumn(CHANGE, F.lit(INSERTED)), batch_id)


def load_incremental(
    table: KeyedTable,
    source: DataFrame,
    compare: tuple[str, ...],
    batch_id: str,
    small: bool = False,
) -> dict[str, int]:
    """Upsert into a keyed table, rewriting only the slices the batch changes; returns the change counts.

    ``small`` is for callers who measured the source.
    """
    if not table.exists():
        return _first_load(table, source, batch_id)
    slices = table.touched_slices(source)
    target = table.read_slices(slices)
    if target is None:
        return _first_load(table, source, batch_id)
    return table.commit_changes(incremental_changes(target, source, table.key, compare, broadcast_source=small), batch_id)


def load_snapshot(
    table: KeyedTable,
    source: DataFrame,
    snapshot_ids: DataFrame,
    compare: tuple[str, ...],
    batch_id: str,
    max_missing_fraction: float | None = None,
    rejected: DataFrame | None = None,
) -> dict[str, int]:
    """Merge a full snapshot into a keyed table, reading whole only slices that it changes; returns the change counts.

    ``rejected`` are the keys that the snapshot lists without a valid row, if the caller knows them.
    """
    target = table.read()
    if target is None:
        return _first_load(table, source, batch_id)
    if max_missing_fraction is not None:
        live = target.where("is_active")
        known = live.count()
        missing = missing_keys(live, snapshot_ids, table.key).count()
        if missing > max_missing_fraction * known:
            raise SuspiciousSnapshot(f"{missing} of {known} active rows are not in the snapshot")
    if rejected is None:
        rejected = missing_keys(snapshot_ids, source, table.key)
    alike = unchanged_slices(target, source, table.slice_of_key(), table.key, compare, rejected).collect()  # one row a slice
    same = {row["slice"]: row["n_rows"] for row in alike}
    rest = [s for s in table.slices() if s not in same]
    changing = ~table.slice_of_key().isin(list(same)) if same else F.lit(True)
    target = table.read_slices(rest)
    if target is None:
        source = source.where(changing)
        if source.isEmpty():
            table.log_nothing(batch_id)
            return dict.fromkeys(CHANGES, 0) | {SAME: sum(same.values())}
        target = table.read().limit(0)
    merged = snapshot_changes(target, source.where(changing), snapshot_ids.where(changing), table.key, compare)
    return table.commit_changes(merged, batch_id, {SAME: sum(same.values())})


def load_folded(
    table: KeyedTable,
    source: DataFrame,
    compare: tuple[str, ...],
    batch_id: str,
    listed: DataFrame | None = None,
    deleting: Sequence[bool] = (),
) -> dict[str, int]:
    """Merge several deliveries (column ``_number``) as if one after the other; returns the change counts."""
    target = table.read() if listed is not None else table.read_slices(table.touched_slices(source))
    if target is None:
        target = source.drop("_number").limit(0)
    merged = folded_changes(target, source, table.key, compare, "_number", listed, deleting)
    return table.commit_changes(merged, batch_id)


def _record_run(
    spark: SparkSession, layout: Layout, entity: Entity, counts: Mapping[str, Mapping[str, int]]
) -> None:
    """The row counts of each batch of a run."""
    rows = [(entity.name, c["total_rows"], c["valid_rows"], c["invalid_rows"], b) for b, c in counts.items()]
    schema = "entity string, total_rows bigint, valid_rows bigint, invalid_rows bigint, batch_id string"
    replace_batch(spark.createDataFrame(rows, schema).coalesce(1), layout.batch_counts)


def _record_changes(spark: SparkSession, layout: Layout, entity: Entity, changes: Mapping[str, int], batch_id: str) -> None:
    """What a run changed in silver, under its last batch."""
    row = (entity.name, *[changes[kind] for kind in CHANGES], batch_id)
    schema = ", ".join(["entity string", *[f"{kind} bigint" for kind in CHANGES], "batch_id string"])
    replace_batch(spark.createDataFrame([row], schema).coalesce(1), layout.change_counts)


def _text_bytes(rows: DataFrame):
    texts = [name for name, kind in rows.dtypes if kind == "string"]
    sizes = [F.coalesce(F.octet_length(name), F.lit(0)).cast("bigint") for name in texts]
    return F.coalesce(F.sum(sum(sizes, F.lit(0).cast("bigint"))), F.lit(0))


def _bronze(spark: SparkSession, layout: Layout, entity: Entity, batch_ids: Sequence[str]) -> DataFrame:
    """The rows of some batches, listing only their folders."""
    if len(batch_ids) == 1:
        return read_batch(spark, layout.bronze(entity), batch_ids[0], entity.bronze_schema)
    path = layout.bronze(entity)
    here = set(files.child_names(spark, path))
    folders = [f"{path}/batch_id={b}" for b in batch_ids if f"batch_id={b}" in here]
    if not folders:
        return spark.createDataFrame([], entity.bronze_schema)
    return spark.read.schema(entity.bronze_schema).option("basePath", path).parquet(*folders)


def run_entity_batches(
    spark: SparkSession,
    entity: Entity,
    sources: Sequence[str],
    layout: Layout,
    options: Options = Options(),
) -> list[BatchResult]:
    """Sources of one entity in order of arrival, from CSV to quarantine and silver.

    Each source (a file or a folder) is a batch; the result is that of one after the
    other. With ``max_missing_fraction``, which looks at the state between
    two snapshots, snapshots do run one after the other.
    """
    sources = list(dict.fromkeys(sources))
    if not sources:
        return []
    if options.max_missing_fraction is not None and entity.snapshot and len(sources) > 1:
        return [run_entity_batch(spark, entity, source, layout, options) for source in sources]
    with tuned(spark):
        return _run(spark, entity, sources, layout, options)


def _run(spark: SparkSession, entity: Entity, sources: list[str], layout: Layout, options: Options) -> list[BatchResult]:
    deliveries = open_batches(spark, entity, sources, layout, options)
    active = [d for d in deliveries if d.action != "skip"]
    for delivery in deliveries:
        if delivery.action == "skip":
            logger.info("%s: content already processed, skipped", delivery.source)
    counts: dict[str, dict[str, int]] = {}
    changes: dict[str, int] = {}
    if active:
        batch_ids = [d.batch_id for d in active]
        typed = standardize(_bronze(spark, layout, entity, batch_ids), entity, options.strict)
        with Workspace(spark, entity.name) as work:
            # Repeated keys are counted on the key column alone; their measured number
            # decides whether the rows themselves have to move.
            within = ["batch_id"] if len(batch_ids) > 1 else []  # the rows of one batch are not told apart by it
            repeated, measured = work.store(repeated_keys(typed, entity.key, *within), "repeated")
            checked = validate(
                typed,
                entity,
                repeated,
                broadcast_repeated=measured["rows"] <= BROADCAST_KEYS,
                within=within,
                many_repeated=measured["rows"] > MOST_FILTERED,
            )
            checked, sizes = work.store(
                checked,
                "checked",
                partition_by=("is_valid",),
                measures=[F.count_if("is_valid").alias("valid_rows"), _text_bytes(checked).alias("text_bytes")],
            )
            counts = {b: {"total_rows": 0, "valid_rows": 0, "invalid_rows": 0} for b in batch_ids}
            for row in batch_counts(checked, "batch_id").collect():  # one row a batch
                counts[row["batch_id"]] = {name: row[name] for name in ("total_rows", "valid_rows", "invalid_rows")}
            logger.info("%s: %s", entity.name, counts)
            valid, invalid = valid_rows(checked), invalid_rows(checked)
            _record_run(spark, layout, entity, counts)
            replace_batch(error_counts(invalid, "batch_id"), layout.error_counts)
            load_quarantine(
                spark, invalid, layout.quarantine(entity), entity.key, batch_ids, options.null_safe_quarantine
            )
            small = sizes["valid_rows"] <= BROADCAST_ROWS and sizes["text_bytes"] <= BROADCAST_TEXT_BYTES
            changes = _load_silver(spark, entity, layout, options, batch_ids, checked, valid, invalid, small)
            _record_changes(spark, layout, entity, changes, batch_ids[-1])
        silver_table(spark, layout, entity).drop_old_versions(options.keep_versions - 1, options.keep_for)
        record_states(spark, layout.control, entity.name, [d.event for d in active], status=SUCCESS)
    return [
        BatchResult(d.batch_id, skipped=True) if d.action == "skip" else BatchResult(d.batch_id, False, **counts[d.batch_id], changes=changes)
        for d in deliveries
    ]


def _load_silver(
    spark: SparkSession,
    entity: Entity,
    layout: Layout,
    options: Options,
    batch_ids: list[str],
    checked: DataFrame,
    valid: DataFrame,
    invalid: DataFrame,
    small: bool,
) -> dict[str, int]:
    table, last = silver_table(spark, layout, entity), batch_ids[-1]
    state = sales_state(spark, layout)
    if state.reports.marks() is not None:  # else the first refresh reads everything
        if entity.name == "orders":
            table.before_commit = lambda new, old: state.feed.add("orders", changed_orders(new, batch_ids))
        elif entity.name == "order_items":
            table.before_commit = lambda new, old: state.feed.add("order_items", changed_items(new, old, batch_ids))
    unkeyed: set[str] = set()
    if options.guard_unkeyed and entity.snapshot:
        rows = invalid.where(F.col(entity.key).isNull()).select("batch_id").distinct()
        unkeyed = {row["batch_id"] for row in rows.collect()}  # at most one row a batch
    if len(batch_ids) > 1:
        number = F.create_map(*[F.lit(x) for n, b in enumerate(batch_ids) for x in (b, n)])[F.col("batch_id")].alias("_number")
        listed = checked.select(entity.key, number) if entity.snapshot else None
        return load_folded(
            table, valid.select("*", number), entity.compare, last, listed, [b not in unkeyed for b in batch_ids]
        )
    if entity.snapshot and not unkeyed:
        return load_snapshot(
            table,
            valid,
            checked.select(entity.key),
            entity.compare,
            last,
            options.max_missing_fraction,
            rejected=invalid.where(F.col(entity.key).isNotNull()).select(entity.key),
        )
    return load_incremental(table, valid, entity.compare, last, small)


def run_entity_batch(
    spark: SparkSession,
    entity: Entity,
    source: str,
    layout: Layout,
    options: Options = Options(),
) -> BatchResult:
    """One source of one entity, from CSV to quarantine and silver."""
    [result] = run_entity_batches(spark, entity, [source], layout, options)
    return result


def silver_table(spark: SparkSession, layout: Layout, entity: Entity) -> KeyedTable:
    return KeyedTable(spark, layout.silver(entity), entity.key, entity.slice_width)


def read_silver(spark: SparkSession, layout: Layout, entity: Entity) -> DataFrame:
    """Current rows of an entity (none, with the right columns, before its first load)."""
    rows = silver_table(spark, layout, entity).read()
    if rows is not None:
        return rows
    bronze = spark.createDataFrame([], entity.bronze_schema)
    return valid_rows(validate(standardize(bronze, entity), entity))


def sales_state(spark: SparkSession, layout: Layout) -> SalesState:
    return SalesState(spark, layout.gold, layout.state)


def refresh_reports(spark: SparkSession, layout: Layout, full: bool = False) -> str:
    """Bring the reports to the current silver tables; all four become visible at once.

    Reads the orders that changed since the last time, or with ``full`` all of them;
    returns which it did, ``changes`` or ``full``.
    """
    silver = {name: read_silver(spark, layout, entity) for name, entity in ENTITIES.items()}
    with tuned(spark):
        return sales_state(spark, layout).refresh(silver, silver_table(spark, layout, ENTITIES["orders"]), full)


def read_report(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """One report of the last rebuild that was finished."""
    return ReportSet(spark, layout.gold).read(name)


def refresh(
    spark: SparkSession,
    sources: Mapping[str, str],
    layout: Layout,
    options: Options = Options(),
) -> dict[str, BatchResult]:
    """All entities in load order, then the reports; the first failure stops the run."""
    results = {
        name: run_entity_batch(spark, entity, sources[name], layout, options)
        for name, entity in ENTITIES.items()
    }
    refresh_reports(spark, layout)
    return results

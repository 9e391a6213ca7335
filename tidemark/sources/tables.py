"""Parquet tables: append, overwrite, one-batch replace, and keyed current state.

A keyed table lives in two folders below its path. ``data`` holds immutable
``version=<n>/slice=<s>`` directories and ``commits`` says which of them are
current. A slice is a range of keys (of wide keys every 1024th range), so a batch
rewrites only the slices its keys fall in. A version becomes visible with its commit; until then a retry simply
writes the same version again. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.merge import CHANGE, SAME, change_counts
from tidemark.sources import files

COMMIT_SCHEMA = "version bigint, slice bigint, batch_id string, committed_at timestamp"


def overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str, *partition_by: str) -> None:
    writer = rows.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_batch(rows: DataFrame, path: str) -> None:
    """Write one batch's partition; a second write of the batch replaces the first."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_batch(spark: SparkSession, path: str, batch_id: str, schema: str) -> DataFrame:
    """One batch of a table partitioned by ``batch_id``, listing only its folder."""
    folder = f"{path}/batch_id={batch_id}"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(folder)


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a table (empty if it does not exist yet)."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


class EventLog:
    """Rows that are added a few at a time and read as a whole.

    ``after-<n>`` holds what was added since fold ``n``, a file each time. When these
    are ``every`` files, ``fold-<n + 1>`` takes up all rows so far, in files by size, and becomes
    visible by a rename. The fold before it stays for readers still in it. However
    many rows were added, a reader lists one fold and fewer than ``every`` files.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, every: int = 64):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.every = every

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}-{number:08d}"

    def _last(self, names: list[str]) -> int:
        return max((int(name.removeprefix("fold-")) for name in names if name.startswith("fold-")), default=0)

    def exists(self) -> bool:
        return files.exists(self.spark, self.path)

    def append(self, rows: DataFrame) -> None:
        last = self._last(files.child_names(self.spark, self.path))
        append(rows.coalesce(1), self._folder("after", last))
        added = files.child_names(self.spark, self._folder("after", last))
        if sum(name.startswith("part-") for name in added) >= self.every:
            self.fold()

    def _current(self) -> list[str]:
        names = files.child_names(self.spark, self.path)
        last = self._last(names)
        return [f"{self.path}/{n}" for n in names if n in (f"fold-{last:08d}", f"after-{last:08d}")]

    def read(self) -> DataFrame:
        """All rows ever added."""
        folders = self._current()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def fold(self) -> None:
        last = self._last(files.child_names(self.spark, self.path))
        overwrite(self.read().hint("rebalance"), f"{self.path}/_fold")
        files.move(self.spark, f"{self.path}/_fold", self._folder("fold", last + 1))
        for kind in ("fold", "after"):
            files.remove(self.spark, self._folder(kind, last - 1))


class ReportSet:
    """Tables that are rebuilt together: versions below ``path``, one commit for all.

    Readers see the last committed version, also while the next one is written or
    after its rebuild failed. The version before stays for readers still in it.
    """

    def __init__(self, spark: SparkSession, path: str, marks: str = ""):
        """``marks`` are columns (DDL) that each commit says about the version, such as what it was made from."""
        self.spark = spark
        self.path = path
        self.schema = f"version bigint, {marks}".rstrip(", ")
        self.commits = f"{path}/commits"

    def marks(self) -> Row | None:
        """The last commit; None before the first."""
        if not files.exists(self.spark, self.commits):
            return None
        return self.spark.read.schema(self.schema).parquet(self.commits).orderBy(F.desc("version")).first()

    def _version(self) -> int:
        """The last committed version; 0 if there is none."""
        last = self.marks()
        return last["version"] if last else 0

    def folder(self) -> str:
        """Where the last committed version is."""
        return f"{self.path}/version={self._version()}"

    def next_folder(self) -> str:
        """Where the next version is written, freed of what a failed rebuild left."""
        folder = f"{self.path}/version={self._version() + 1}"
        files.remove(self.spark, folder)
        return folder

    def publish(self, marks: Mapping[str, int] | None = None) -> int:
        version = self._version() + 1
        row = {"version": version, **(marks or {})}
        names = [part.split()[0] for part in self.schema.split(", ")]
        append(self.spark.createDataFrame([tuple(row[n] for n in names)], self.schema).coalesce(1), self.commits)
        if version > 2:
            files.remove(self.spark, f"{self.path}/version={version - 2}")
        return version

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder()}/{name}")


#: A keyed table never has more slices than this.
MOST_SLICES = 1024


class KeyedTable:
    """Current-state table with one row per key."""

    def __init__(self, spark: SparkSession, path: str, key: str, width: int):
        self.spark = spark
        self.key = key
        self.width = width
        self.data = f"{path}/data"
        self.commits = EventLog(spark, f"{path}/commits", COMMIT_SCHEMA)
        #: Called with a version's new slices and their old content (None if new) before the version becomes current.
        self.before_commit: Callable[[DataFrame, DataFrame | None], None] | None = None
        self._known: tuple[int, dict[int, int]] | None = None

    def exists(self) -> bool:
        return self.commits.exists()

    def slice_of_key(self) -> Column:
        """Ranges of keys, dealt over a fixed number of slices."""
        key, width = F.col(self.key).cast("bigint"), F.lit(self.width).cast("bigint")
        # Whole numbers only: dividing decimals costs more than writing the row. ``div`` cuts towards zero.
        below = F.when(key % width < 0, F.lit(1)).otherwise(F.lit(0))
        return F.pmod(F.call_function("div", key, width) - below, F.lit(MOST_SLICES).cast("bigint"))

    def _state(self) -> tuple[int, dict[int, int]]:
        """Last version, and the current version of every slice, as of the first look or the last own commit.

        Metadata only: one entry per slice.
        """
        if self._known is None:
            newest = self.commits.read().groupBy("slice").agg(F.max("version").alias("version")).collect() if self.exists() else []
            current = {row["slice"]: row["version"] for row in newest if row["slice"] is not None}
            self._known = max((row["version"] for row in newest), default=0), current
        return self._known

    def slices(self) -> list[int]:
        """Slices that have rows."""
        return sorted(self._state()[1])

    def _read(self, slices: dict[int, int]) -> DataFrame | None:
        if not slices:
            return None
        folders = [f"{self.data}/version={v}/slice={s}" for s, v in sorted(slices.items())]
        reader = self.spark.read.option("basePath", self.data)
        return reader.parquet(*folders).drop("version", "slice")

    def read(self) -> DataFrame | None:
        """All current rows; None if the table has none yet."""
        return self._read(self._state()[1])

    def touched_slices(self, rows: DataFrame) -> list[int]:
        found = rows.select(self.slice_of_key().alias("slice")).distinct().collect()
        return [row["slice"] for row in found]

    def read_slices(self, slices: list[int]) -> DataFrame | None:
        """Current rows of the given slices; None if there are none yet."""
        current = self._state()[1]
        return self._read({s: current[s] for s in slices if s in current})

    def commit(self, rows: DataFrame, batch_id: str) -> int:
        """Write ``rows`` as the new content of the slices they fall in; returns the version."""
        return self._commit(rows, batch_id)[0]

    def commit_changes(self, rows: DataFrame, batch_id: str, skipped: Mapping[str, int] | None = None) -> dict[str, int]:
        """Write the rows of a merge with its labels (``CHANGE``); returns how many have each.

        They are counted while they are written, and slices in which nothing changed
        stay at their version. ``skipped`` are counts of rows that the caller left out.
        """
        counts = self._commit(rows, batch_id)[1]
        return {kind: n + (skipped or {}).get(kind, 0) for kind, n in counts.items()}

    def _commit(self, rows: DataFrame, batch_id: str) -> tuple[int, dict[str, int]]:
        version = self._state()[0] + 1
        folder = f"{self.data}/version={version}"
        # Even output files per slice, however the merge was partitioned.
        sliced = rows.withColumn("slice", self.slice_of_key()).hint("rebalance", "slice")
        observed = None
        if CHANGE in rows.columns:
            observed = Observation()
            changed = F.when(F.col(CHANGE) != SAME, F.col("slice"))
            sliced = sliced.observe(observed, *change_counts(), F.bitmap_construct_agg(changed).alias("changed")).drop(CHANGE)
        sliced.write.mode("overwrite").partitionBy("slice").parquet(folder)
        names = [n for n in files.child_names(self.spark, folder) if n.startswith("slice=")]
        written = [int(name.removeprefix("slice=")) for name in names]
        counts: dict[str, int] = {}
        if observed is not None:
            counts = dict(observed.get)
            bits = bytes(counts.pop("changed") or b"")
            changed = {s for s in written if bits[s >> 3] >> (s & 7) & 1}
            for same in set(written) - changed:
                files.remove(self.spark, f"{folder}/slice={same}")
            written = sorted(changed)
        if not written:
            files.remove(self.spark, folder)
        if self.before_commit is not None and written:
            self.before_commit(self._read(dict.fromkeys(written, version)), self.read_slices(written))
        self.log(version, written, batch_id)
        return version, counts

    def version(self) -> int:
        """The last committed version; 0 if there is none."""
        return self._state()[0]

    def log(self, version: int, slices: list[int], batch_id: str) -> None:
        """Make a version current. One without slices is recorded too: the table then exists, and may be empty."""
        entries = [(version, s, batch_id) for s in slices] or [(version, None, batch_id)]
        now = datetime.now(timezone.utc)
        current = self._state()[1] | dict.fromkeys(slices, version)
        self.commits.append(self.spark.createDataFrame([(*entry, now) for entry in entries], COMMIT_SCHEMA))
        self._known = version, current

    def log_nothing(self, batch_id: str) -> None:
        """Record a load that changed nothing."""
        self.log(self._state()[0] + 1, [], batch_id)

    def drop_old_versions(self, keep: int = 2, older_than: timedelta = timedelta(0)) -> list[str]:
        """Delete slices replaced more than ``keep`` versions ago and at least ``older_than`` ago; returns their folders."""
        on_disk = [int(n.removeprefix("version=")) for n in files.child_names(self.spark, self.data) if "=" in n]
        if len(on_disk) <= keep + 1:
            return []
        last = self._state()[0]
        order = Window.partitionBy("slice").orderBy("version")
        log = self.commits.read().where("slice IS NOT NULL").select(
            "version", "slice", F.lead("version").over(order).alias("next"), F.lead("committed_at").over(order).alias("replaced")
        )
        aged = F.col("replaced") <= F.lit(datetime.now(timezone.utc) - older_than)
        old = log.where((F.col("next") <= last - keep) & aged & F.col("version").isin(on_disk))
        # Of versions still on disk only; the log also knows those dropped before.
        found = [(row["version"], row["slice"]) for row in old.collect()]
        dropped = []
        for version in {v for v, _ in found}:
            folder = f"{self.data}/version={version}"
            here = {n for n in files.child_names(self.spark, folder) if "=" in n}
            gone = {f"slice={s}" for v, s in found if v == version} & here
            # A version of which nothing is current or needed goes as a whole.
            paths = [folder] if gone == here else [f"{folder}/{name}" for name in sorted(gone)]
            for path in paths:
                files.remove(self.spark, path)
            dropped += [f"{folder}/{name}" for name in sorted(gone)]
        return dropped

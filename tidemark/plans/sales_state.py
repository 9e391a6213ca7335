"""Reports that follow the changes of silver: stored lines by order, stored totals by group.

``lines`` holds every order item beside what the reports need of its order and
product, in slices of order ids. Each load that changes orders or items leaves a
*feed* of them. A refresh takes the feed since the last one, replaces the lines of
the orders in it, and moves each group's totals by the difference between these orders'
old and new sums; all other orders and groups are not read. The first
refresh, and one after a refresh that was lost half-way, builds everything anew.

Sums are by group and order before they are by group, so an order counts once in a
group and a hot group is spread over its orders. Counts and money are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contracts import ORDER_ITEMS, ORDERS
from tidemark.functions.values import line_revenue
from tidemark.plans.reports import GROUPS, category_report, customer_report, day_report, product_report
from tidemark.sources import files
from tidemark.sources.tables import KeyedTable, ReportSet, overwrite
from tidemark.sources.workspace import Workspace

ITEM = ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]
MARKS = "state bigint, lines bigint, orders bigint, order_items bigint"
MONEY = "decimal(38,2)"


class Feed:
    """The orders and items that loads changed, one folder a load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def runs(self, entity: str) -> list[int]:
        return sorted(int(n.removeprefix("run=")) for n in files.child_names(self.spark, f"{self.path}/{entity}") if "=" in n)

    def add(self, entity: str, rows: DataFrame) -> None:
        run = max(self.runs(entity), default=0) + 1
        overwrite(rows, f"{self.path}/{entity}/run={run}")

    def since(self, entity: str, mark: int) -> DataFrame | None:
        """What loads after ``mark`` changed, with their ``run``."""
        new = [f"{self.path}/{entity}/run={run}" for run in self.runs(entity) if run > mark]
        if not new:
            return None
        return self.spark.read.option("basePath", f"{self.path}/{entity}").parquet(*new)

    def last(self, entity: str) -> int:
        return max(self.runs(entity), default=0)

    def drop_before(self, entity: str, mark: int) -> None:
        """Forget what was taken up; the last folder stays, as its number counts on."""
        for run in self.runs(entity):
            if run < mark:
                files.remove(self.spark, f"{self.path}/{entity}/run={run}")


def changed_orders(new: DataFrame, batch_ids: Sequence[str]) -> DataFrame:
    """Of a load of orders: the ids of those it inserted or replaced."""
    return new.where(F.col("batch_id").isin(list(batch_ids))).select("order_id")


def changed_items(new: DataFrame, old: DataFrame | None, batch_ids: Sequence[str]) -> DataFrame:
    """Of a load of items: those it inserted or replaced, with the order that each belonged to before."""
    changed = new.where(F.col("batch_id").isin(list(batch_ids))).select(ITEM)
    if old is None:
        return changed.withColumn("old_order_id", F.lit(None).cast(new.schema["order_id"].dataType))
    return changed.join(old.select("order_item_id", F.col("order_id").alias("old_order_id")), "order_item_id", "left")


def _lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their order and category; ``counted`` if the order is completed."""
    of_order = orders.select("order_id", "customer_id", "order_date", (F.col("status") == "completed").alias("counted"))
    categories = products.groupBy("product_id").agg(F.first("category").alias("category"))
    joined = items.join(of_order, "order_id", "left").join(categories, "product_id", "left")
    return joined.select(*ITEM, "customer_id", "order_date", F.coalesce("counted", F.lit(False)).alias("counted"), "category")


def order_sums(lines: DataFrame, group: str) -> DataFrame:
    """What each order adds to each of its groups."""
    counted = lines.where(F.col("counted") & F.col("order_item_id").isNotNull() & F.col(group).isNotNull())
    keys = [F.col(group), F.col("order_id"), *([F.col("order_date")] if group != "order_date" else [])]
    return counted.groupBy(*keys).agg(
        F.sum("quantity").cast("bigint").alias("items"), F.sum(line_revenue()).cast(MONEY).alias("revenue")
    )


def totals(sums: DataFrame, group: str) -> DataFrame:
    """Orders, items, money, and first and last day of each group."""
    return sums.withColumn("day", F.col("order_date")).groupBy(group).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("items").alias("items"),
        F.sum("revenue").cast(MONEY).alias("revenue"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def moved_totals(before: DataFrame, old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """Totals after some orders' sums ``old`` became ``new``; ``unsure`` where a first or last day may have gone."""
    minus, plus = totals(old, group), totals(new, group)
    named = [
        rows.select(group, F.struct("order_count", "items", "revenue", "first_day", "last_day").alias(name))
        for name, rows in (("was", before), ("minus", minus), ("plus", plus))
    ]
    both = reduce(lambda a, b: a.join(b, group, "full_outer"), named)

    def moved(name: str):
        zero = F.lit(0)
        parts = [F.coalesce(f"{side}.{name}", zero) for side in ("was", "minus", "plus")]
        return parts[0] - parts[1] + parts[2]

    lost = (F.col("minus.first_day") <= F.col("was.first_day")) | (F.col("minus.last_day") >= F.col("was.last_day"))
    after = both.select(
        group,
        moved("order_count").alias("order_count"),
        moved("items").alias("items"),
        moved("revenue").cast(MONEY).alias("revenue"),
        F.least("was.first_day", "plus.first_day").alias("first_day"),
        F.greatest("was.last_day", "plus.last_day").alias("last_day"),
        F.coalesce(lost, F.lit(False)).alias("unsure"),
    )
    return after.where("order_count > 0")


class SalesState:
    """Lines, totals and reports of one lake."""

    def __init__(self, spark: SparkSession, gold: str, state: str):
        self.spark = spark
        self.reports = ReportSet(spark, gold, MARKS)
        self.path = state
        self.feed = Feed(spark, f"{state}/changes")

    def _lines_of(self, state: int) -> KeyedTable:
        """The stored lines; every rebuild begins a table of its own."""
        return KeyedTable(self.spark, f"{self.path}/lines-{state}", "order_id", ORDERS.slice_width)

    def refresh(self, silver: Mapping[str, DataFrame], orders: KeyedTable, full: bool = False) -> str:
        """Bring all reports up to date; says whether it did ``full``y or by ``changes``."""
        marks = self.reports.marks()
        if marks is not None:
            self.lines = self._lines_of(marks["state"])
        if full or marks is None or self.lines.version() != marks["lines"]:
            return self._rebuild(silver)
        return self._follow(silver, orders, marks)

    def _publish(self, folder: str, silver: Mapping[str, DataFrame], marks: Mapping[str, int]) -> None:
        def stored(name: str) -> DataFrame:
            group, items_name, revenue_name = GROUPS[name]
            rows = self.spark.read.parquet(f"{folder}/totals_{name}").withColumnsRenamed({"items": items_name, "revenue": revenue_name})
            dates = {"first_day": "first_order_date", "last_day": "last_order_date"}
            return rows.withColumnsRenamed(dates) if name == "customer_metrics" else rows.drop(*dates)

        shown = {
            "daily_sales": day_report(stored("daily_sales")),
            "product_performance": product_report(stored("product_performance"), silver["products"]),
            "category_performance": category_report(stored("category_performance")),
            "customer_metrics": customer_report(stored("customer_metrics"), silver["customers"]),
        }
        for name, report in shown.items():
            overwrite(report, f"{folder}/{name}")
        self.reports.publish(marks)
        for entity in ("orders", "order_items"):
            self.feed.drop_before(entity, marks[entity])
        self.lines.drop_old_versions(keep=1)
        for state in self._states():
            if state < marks["state"]:
                files.remove(self.spark, f"{self.path}/lines-{state}")

    def _states(self) -> list[int]:
        names = files.child_names(self.spark, self.path)
        return sorted(int(n.removeprefix("lines-")) for n in names if n.startswith("lines-"))

    def _marks(self) -> dict[str, int]:
        return {entity: self.feed.last(entity) for entity in ("orders", "order_items")}

    def _rebuild(self, silver: Mapping[str, DataFrame]) -> str:
        marks, folder = self._marks(), self.reports.next_folder()
        marks["state"] = max(self._states(), default=0) + 1
        self.lines = self._lines_of(marks["state"])
        self.lines.commit(_lines(silver["order_items"].select(ITEM), silver["orders"], silver["products"]), "rebuild")
        marks["lines"] = self.lines.version()
        lines = self.lines.read()
        if lines is None:
            lines = _lines(silver["order_items"].select(ITEM), silver["orders"], silver["products"]).limit(0)
        for name, (group, *_) in GROUPS.items():
            overwrite(totals(order_sums(lines, group), group), f"{folder}/totals_{name}")
        overwrite(silver["products"].select("product_id", "category"), f"{folder}/categories")
        self._publish(folder, silver, marks)
        return "full"

    def _follow(self, silver: Mapping[str, DataFrame], orders: KeyedTable, since: Mapping[str, int]) -> str:
        marks, before, folder = self._marks(), self.reports.folder(), self.reports.next_folder()
        with Workspace(self.spark, "sales-state") as work:
            items = self._last_items(since["order_items"])
            changed, _ = work.store(self._touched(silver, items, since["orders"], f"{before}/categories"), "changed")
            slices = self.lines.touched_slices(changed)
            stored = self.lines.read_slices(slices)
            known = self.lines.read()
            kind = (known if known is not None else _lines(items, silver["orders"], silver["products"])).limit(0)
            stored = stored if stored is not None else kind
            old, _ = work.store(stored.join(changed, "order_id", "left_semi"), "old")
            kept = old.where("order_item_id IS NOT NULL").select(ITEM).join(items.select("order_item_id"), "order_item_id", "left_anti")
            now = kept.unionByName(items.select(ITEM))
            # Every changed order keeps a row, so that a slice whose items all moved away is replaced too.
            now = changed.join(now, "order_id", "left").select(ITEM)
            of_slices = orders.read_slices(slices)
            fresh = _lines(now, of_slices if of_slices is not None else silver["orders"].limit(0), silver["products"])
            fresh, _ = work.store(fresh, "new")
            if slices:
                self.lines.commit(stored.join(changed, "order_id", "left_anti").unionByName(fresh), "changes")
            marks |= {"state": since["state"], "lines": self.lines.version()}
            for name, (group, *_) in GROUPS.items():
                was = self.spark.read.parquet(f"{before}/totals_{name}")
                moved = moved_totals(was, order_sums(old, group), order_sums(fresh, group), group)
                if name == "customer_metrics":
                    moved = self._with_days(work, moved)
                overwrite(moved.drop("unsure"), f"{folder}/totals_{name}")
            overwrite(silver["products"].select("product_id", "category"), f"{folder}/categories")
            self._publish(folder, silver, marks)
        return "changes"

    def _last_items(self, mark: int) -> DataFrame:
        """The changed items as the last of their loads left them, and the orders they were in."""
        found = self.feed.since("order_items", mark)
        if found is None:
            kinds = ", ".join(f"{c} {ORDER_ITEMS.columns[c]}" for c in ITEM)
            return self.spark.createDataFrame([], f"{kinds}, before array<int>")
        row = F.max_by(F.struct(*ITEM), "run").alias("row")
        return found.groupBy("order_item_id").agg(row, F.collect_set("old_order_id").alias("before")).select("row.*", "before")

    def _touched(self, silver: Mapping[str, DataFrame], items: DataFrame, mark: int, categories: str) -> DataFrame:
        """Ids of orders whose lines may differ from the stored ones."""
        found = [items.select("order_id"), items.select(F.explode("before").alias("order_id"))]
        orders = self.feed.since("orders", mark)
        if orders is not None:
            found.append(orders.select("order_id"))
        was = self.spark.read.parquet(categories).select("product_id", F.col("category").alias("was"))
        now = silver["products"].select("product_id", "category")
        moved = now.join(was, "product_id", "full_outer").where(~F.col("category").eqNullSafe(F.col("was"))).select("product_id")
        lines = self.lines.read()
        if lines is not None and not moved.isEmpty():
            found.append(lines.select("product_id", "order_id").join(moved, "product_id", "left_semi").select("order_id"))
        return reduce(DataFrame.union, found).distinct()

    def _with_days(self, work: Workspace, moved: DataFrame) -> DataFrame:
        """First and last days looked up again where an order that made one of them changed."""
        moved, _ = work.store(moved, "customers")
        unsure = moved.where("unsure").select("customer_id")
        lines = self.lines.read()
        if lines is None or unsure.isEmpty():
            return moved
        counted = lines.where("counted AND order_item_id IS NOT NULL").select("customer_id", "order_date")
        days = counted.join(unsure, "customer_id", "left_semi").groupBy("customer_id")
        days = days.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
        return moved.join(days, "customer_id", "left").select(
            "customer_id", "order_count", "items", "revenue", F.coalesce("first", "first_day").alias("first_day"), F.coalesce("last", "last_day").alias("last_day")
        )

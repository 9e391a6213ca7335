"""Reports that follow changes: equal to brute force after any change, reading only what changed."""

import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import ORDER_ITEMS, ORDERS, Layout, read_report, refresh_reports, run_entity_batch
from tidemark.plans import jobs, sales_state
from tidemark.plans.sales_state import SalesState, changed_items, changed_orders

WIDE = 4_194_304
CENT = Decimal("0.01")


class Shop:
    """Silver as dicts, and the reports that follow it."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.orders, self.items = {}, {}
        self.products = {1: ("lamp", "home"), 2: ("desk", "office"), 3: ("pen", "office")}
        self.customers = {1: ("Ines", "Moreau", "France"), 2: ("Jo", "Li", "China")}
        self.read = []

    def frame(self, schema, rows):
        return self.spark.createDataFrame([(k, *v) for k, v in rows.items()], schema)

    def silver(self):
        return {
            "orders": self.frame("order_id int, customer_id int, order_date date, status string", self.orders),
            "order_items": self.frame("order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2)", self.items),
            "products": self.frame("product_id int, name string, category string", self.products),
            "customers": self.frame("customer_id int, first_name string, last_name string, country string", self.customers),
        }

    def read_slices(self, slices):
        """The orders table, as far as a refresh asks for it."""
        self.read.append(slices)
        rows = {k: v for k, v in self.orders.items() if k // WIDE in slices}
        return self.frame("order_id int, customer_id int, order_date date, status string", rows) if rows else None

    def state(self):
        return SalesState(self.spark, f"{self.path}/gold", f"{self.path}/state")

    def change(self, orders=None, items=None):
        """A load of orders or of items, as it tells the feed."""
        before, feed = self.silver()["order_items"], self.state().feed
        self.orders |= {k: (c, date(2025, 2, d), s) for k, (c, d, s) in (orders or {}).items()}
        self.items |= {k: (o, p, q, Decimal(price)) for k, (o, p, q, price) in (items or {}).items()}
        mark = F.when(F.col("order_id" if orders else "order_item_id").isin(list(orders or items)), "new").otherwise("old")
        if orders:
            feed.add("orders", changed_orders(self.silver()["orders"].withColumn("batch_id", mark), ["new"]))
        if items:
            feed.add("order_items", changed_items(self.silver()["order_items"].withColumn("batch_id", mark), before, ["new"]))

    def refresh(self, full=False):
        return self.state().refresh(self.silver(), self, full)

    def shown(self):
        names = {
            "daily_sales": ("order_date", "order_count", "items_sold", "revenue", "average_order_value"),
            "product_performance": ("product_id", "name", "category", "order_count", "items_sold", "revenue", "average_selling_price"),
            "category_performance": ("category", "order_count", "items_sold", "revenue", "average_selling_price"),
            "customer_metrics": ("customer_id", "order_count", "items_bought", "total_spent", "average_order_value", "first_order_date", "last_order_date", "first_name", "last_name", "country"),
        }
        reports = self.state().reports
        return {n: sorted(map(str, (tuple(r) for r in reports.read(n).select(*columns).collect()))) for n, columns in names.items()}

    def expected(self):
        lines = [(o, *self.orders[o], p, q, q * price) for o, p, q, price in self.items.values() if o in self.orders and self.orders[o][2] == "completed"]

        def totals(key):
            groups = {}
            for line in lines:
                if key(line) is not None:
                    groups.setdefault(key(line), []).append(line)
            return {
                g: (len({x[0] for x in found}), sum(x[5] for x in found), sum(x[6] for x in found), min(x[2] for x in found), max(x[2] for x in found))
                for g, found in groups.items()
            }

        def per(money, count):
            return (money / count).quantize(CENT, ROUND_HALF_UP)

        days, products, customers = totals(lambda x: x[2]), totals(lambda x: x[4]), totals(lambda x: x[1])
        categories = totals(lambda x: self.products.get(x[4], (None, None))[1])
        rows = {
            "daily_sales": [(d, n, i, m, per(m, n)) for d, (n, i, m, *_) in days.items()],
            "product_performance": [(p, *self.products[p], n, i, m, per(m, i)) for p, (n, i, m, *_) in products.items() if p in self.products],
            "category_performance": [(c, n, i, m, per(m, i)) for c, (n, i, m, *_) in categories.items()],
            "customer_metrics": [(c, n, i, m, per(m, n), a, b, *self.customers.get(c, (None,) * 3)) for c, (n, i, m, a, b) in customers.items()],
        }
        return {n: sorted(map(str, found)) for n, found in rows.items()}


@pytest.fixture
def shop(spark, tmp_path):
    made = Shop(spark, tmp_path)
    made.change(orders={1: (1, 1, "completed"), 2: (1, 3, "completed"), 3: (2, 2, "pending"), WIDE: (2, 1, "completed")})
    made.change(items={1: (1, 1, 2, "10.00"), 2: (1, 2, 1, "20.00"), 3: (2, 2, 5, "19.00"), 4: (3, 3, 1, "1.00"), 5: (WIDE, 7, 1, "3.00"), 6: (1, 1, 1, "9.50")})
    assert made.refresh() == "full"
    assert made.shown() == made.expected()
    return made


def test_reports_follow_every_kind_of_change(shop):
    def follow():
        assert shop.refresh() == "changes"
        assert shop.shown() == shop.expected()

    shop.change(orders={3: (2, 2, "completed")})  # completes
    shop.change(orders={1: (1, 4, "completed")})  # takes away a customer's first day
    follow()
    shop.change(orders={2: (2, 3, "completed"), WIDE: (2, 1, "cancelled")})  # another customer; the last of a slice
    shop.change(items={90: (9, 1, 1, "10.00")})  # before its order
    follow()
    shop.change(orders={9: (1, 9, "completed"), 10: (1, 9, "completed")})
    shop.change(items={5: (2, 7, 1, "3.00")})  # the only item of a slice moves away
    shop.change(items={2: (2, 3, 7, "0.99")})  # moves, and has another product and price
    shop.change(items={2: (WIDE, 3, 4, "0.99"), 91: (10, 2, 1, "5.00")})  # moves again
    follow()
    shop.products = {1: ("LAMP", "home"), 2: ("desk", "home"), 3: ("pen", "office"), 7: ("cup", "kitchen")}
    shop.customers[1] = ("Inez", "Moreau", "France")
    follow()
    shop.change(orders={k: (1, 1, "cancelled") for k in (1, 2, 3, 9, 10)})  # nothing is left
    follow()
    assert shop.shown()["daily_sales"] == []


def test_many_changes_in_a_row(shop):
    draw = random.Random(11)
    keys = [*range(1, 12), WIDE, WIDE + 1]
    for _ in range(3):
        for _ in range(3):
            shop.change(orders={k: (draw.randint(1, 3), draw.randint(1, 9), draw.choice(["completed", "completed", "pending"])) for k in draw.sample(keys, 4)})
            shop.change(items={k: (draw.choice(keys), draw.randint(1, 4), draw.randint(1, 5), f"{draw.randint(1, 900) / 100:.2f}") for k in draw.sample(range(1, 25), 6)})
        assert shop.refresh() == "changes"
        assert shop.shown() == shop.expected()


def test_a_lost_refresh_is_made_good(shop, monkeypatch):
    before = shop.shown()
    shop.change(orders={3: (2, 2, "completed")})
    with monkeypatch.context() as patch:
        patch.setattr(SalesState, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            shop.refresh()
    assert shop.shown() == before
    assert shop.refresh() == "full"  # the lines had gone ahead of the totals
    assert shop.shown() == shop.expected()
    shop.change(items={2: (2, 2, 1, "20.00")})
    assert shop.refresh() == "changes"
    assert shop.shown() == shop.expected()


def test_only_slices_of_changed_orders_are_read_and_written(spark, shop):
    shop.change(orders={WIDE: (2, 1, "cancelled")})
    shop.read.clear()
    assert shop.refresh() == "changes"
    assert shop.read == [[1]]
    lines = spark.read.parquet(f"{shop.path}/state/lines-1/data").select("version", "slice").distinct()
    assert {tuple(r) for r in lines.collect()} == {(1, 0), (1, 1), (2, 1)}


def test_loads_tell_the_feed_even_if_they_are_lost(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path / "lake"))

    def deliver(entity, name, body):
        path = tmp_path / f"{name}.csv"
        path.write_text(",".join(entity.columns) + "\n" + body)
        return run_entity_batch(spark, entity, str(path), layout)

    deliver(ORDERS, "o1", "1,1,2025-02-01,completed\n2,1,2025-02-01,completed\n")
    deliver(ORDER_ITEMS, "i1", "1,1,1,2,10.00\n2,2,1,1,1.00\n")
    assert refresh_reports(spark, layout) == "full"
    with monkeypatch.context() as patch:
        patch.setattr(jobs.KeyedTable, "log", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            deliver(ORDER_ITEMS, "i2", "2,1,1,5,1.00\n")
    deliver(ORDER_ITEMS, "i2", "2,1,1,5,1.00\n")
    found = jobs.sales_state(spark, layout).feed.since("order_items", 0)
    assert {(r["order_item_id"], r["order_id"], r["old_order_id"]) for r in found.collect()} == {(2, 1, 2)}
    assert refresh_reports(spark, layout) == "changes"
    assert [tuple(r)[:3] for r in read_report(spark, layout, "daily_sales").collect()] == [(date(2025, 2, 1), 1, 7)]


def test_a_group_is_summed_by_order_first(frame):
    schema = "order_id int, order_item_id int, product_id int, quantity int, unit_price decimal(10,2), customer_id int, order_date date, counted boolean, category string"
    plan = sales_state.totals(sales_state.order_sums(frame(schema), "category"), "category")._jdf.queryExecution().executedPlan().toString()
    first = plan.split("HashAggregate(keys=[category")[-1].split("]")[0]
    assert "order_id" in first

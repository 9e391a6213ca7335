from datetime import date
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import (
    build_reports,
    category_performance,
    customer_metrics,
    daily_sales,
    product_performance,
    sales_lines,
)

D = Decimal
ORDERS = "order_id int, customer_id int, order_date date, status string"
ITEMS = "order_item_id int, order_id int, product_id int, quantity int, unit_price decimal(10,2)"
PRODUCTS = "product_id int, name string, category string, is_active boolean"
CUSTOMERS = "customer_id int, first_name string, last_name string, country string"


@pytest.fixture
def shop(frame):
    monday, tuesday = date(2025, 6, 2), date(2025, 6, 3)
    orders = frame(
        ORDERS,
        (1, 50, monday, "completed"),
        (2, 50, tuesday, "completed"),
        (3, 51, tuesday, "completed"),
        (4, 50, tuesday, "cancelled"),
        (5, 52, tuesday, "completed"),  # has no items
        (6, 51, tuesday, "Completed"),  # not a known status
    )
    items = frame(
        ITEMS,
        (1, 1, 9, 3, D("2.50")),
        (2, 1, 8, 1, D("10.00")),
        (3, 2, 9, 2, D("3.00")),
        (4, 3, 7, 3, D("0.33")),
        (5, 3, 77, 1, D("5.00")),  # unknown product
        (6, 4, 9, 9, D("9.00")),
        (7, 6, 9, 9, D("9.00")),
        (8, 99, 9, 9, D("9.00")),  # unknown order
        (9, None, 9, 9, D("9.00")),
    )
    products = frame(
        PRODUCTS,
        (9, "pen", "office", True),
        (8, "ink", "office", False),  # soft-deleted products still report
        (7, "mug", "kitchen", True),
    )
    customers = frame(CUSTOMERS, (50, "Ines", "Moreau", "France"))
    return orders, items, products, customers


def rows(report, *order):
    return [tuple(row) for row in report.orderBy(*order).collect()]


def test_sales_lines(shop):
    orders, items, *_ = shop
    lines = sales_lines(orders, items)
    assert lines.columns == [
        "order_id",
        "customer_id",
        "order_date",
        "product_id",
        "quantity",
        "line_revenue",
    ]
    assert lines.schema["line_revenue"].dataType.simpleString() == "decimal(21,2)"
    assert lines.count() == 5


def test_daily_sales(shop):
    orders, items, *_ = shop
    report = daily_sales(orders, items)
    assert report.schema.simpleString() == (
        "struct<order_date:date,order_count:bigint,items_sold:bigint,"
        "revenue:decimal(18,2),average_order_value:decimal(18,2)>"
    )
    assert rows(report, "order_date") == [
        (date(2025, 6, 2), 1, 4, D("17.50"), D("17.50")),
        (date(2025, 6, 3), 2, 6, D("11.99"), D("6.00")),
    ]


def test_product_performance(shop):
    orders, items, products, _ = shop
    report = product_performance(orders, items, products)
    assert report.schema["revenue"].dataType.simpleString() == "decimal(31,2)"
    assert report.schema["average_selling_price"].dataType.simpleString() == "decimal(32,2)"
    assert rows(report, "product_id") == [
        (7, "mug", "kitchen", 1, 3, D("0.99"), D("0.33")),
        (8, "ink", "office", 1, 1, D("10.00"), D("10.00")),
        (9, "pen", "office", 2, 5, D("13.50"), D("2.70")),
    ]


def test_category_performance_counts_an_order_once(shop):
    orders, items, products, _ = shop
    assert rows(category_performance(orders, items, products), "category") == [
        ("kitchen", 1, 3, D("0.99"), D("0.33")),
        ("office", 2, 6, D("23.50"), D("3.92")),
    ]


def test_customer_metrics_keep_unknown_customers(shop):
    orders, items, _, customers = shop
    report = customer_metrics(orders, items, customers)
    assert report.columns == [
        "customer_id",
        "order_count",
        "items_bought",
        "total_spent",
        "first_order_date",
        "last_order_date",
        "average_order_value",
        "first_name",
        "last_name",
        "country",
    ]
    june2, june3 = date(2025, 6, 2), date(2025, 6, 3)
    assert rows(report, "customer_id") == [
        (50, 2, 6, D("23.50"), june2, june3, D("11.75"), "Ines", "Moreau", "France"),
        (51, 1, 4, D("5.99"), june3, june3, D("5.99"), None, None, None),
    ]


def test_averages_round_half_up(frame):
    day = date(2025, 1, 1)
    orders = frame(ORDERS, (1, 1, day, "completed"), (2, 1, day, "completed"))
    items = frame(ITEMS, (1, 1, 1, 1, D("0.01")), (2, 2, 1, 1, D("0.02")))
    assert rows(daily_sales(orders, items), "order_date")[0][4] == D("0.02")


def test_no_units_gives_no_average(frame):
    orders = frame(ORDERS, (1, 1, date(2025, 1, 1), "completed"))
    items = frame(ITEMS, (1, 1, 1, 0, D("5.00")))
    products = frame(PRODUCTS, (1, "pen", "office", True))
    assert rows(product_performance(orders, items, products), "product_id")[0][6] is None
    assert rows(category_performance(orders, items, products), "category")[0][4] is None


def test_repeated_order_rows_count_their_items_again(frame):
    row = (1, 1, date(2025, 1, 1), "completed")
    orders = frame(ORDERS, row, row)
    items = frame(ITEMS, (1, 1, 1, 2, D("5.00")))
    assert rows(daily_sales(orders, items), "order_date") == [
        (date(2025, 1, 1), 1, 4, D("20.00"), D("20.00"))
    ]


def test_built_reports_equal_the_single_ones(spark, shop, tmp_path):
    orders, items, products, customers = shop
    single = {
        "daily_sales": daily_sales(orders, items),
        "product_performance": product_performance(orders, items, products),
        "category_performance": category_performance(orders, items, products),
        "customer_metrics": customer_metrics(orders, items, customers),
    }
    paths = {name: str(tmp_path / name) for name in single}
    for _ in range(2):  # a rebuild overwrites
        build_reports(orders, items, products, customers, paths)
    for name, report in single.items():
        stored = spark.read.parquet(paths[name])
        assert stored.schema.simpleString() == report.schema.simpleString()
        assert rows(stored, *stored.columns) == rows(report, *report.columns)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


lines = st.lists(
    st.tuples(
        st.integers(1, 4), st.integers(1, 3), st.integers(1, 5), st.integers(0, 999)
    ),
    min_size=1,
    max_size=12,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(lines)
def test_all_reports_add_up_to_the_same_revenue(frame, drawn):
    orders = frame(
        ORDERS, *[(k, k % 2, date(2025, 1, 1 + k % 2), "completed") for k in range(1, 5)]
    )
    items = frame(
        ITEMS, *[(i, o, p, q, D(c) / 100) for i, (o, p, q, c) in enumerate(drawn, start=1)]
    )
    products = frame(PRODUCTS, *[(k, f"p{k}", f"c{k % 2}", True) for k in range(1, 4)])
    customers = frame(CUSTOMERS, (0, "a", "b", "c"))
    total = D(sum(q * c for _, _, q, c in drawn)) / 100

    def summed(report, column):
        return report.agg(F.sum(column)).first()[0]

    assert summed(daily_sales(orders, items), "revenue") == total
    assert summed(product_performance(orders, items, products), "revenue") == total
    assert summed(category_performance(orders, items, products), "revenue") == total
    assert summed(customer_metrics(orders, items, customers), "total_spent") == total

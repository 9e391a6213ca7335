from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, standardize
from tidemark.functions.values import typed as typed_column


def typed(frame, entity, *rows, **options):
    result = standardize(frame(entity.raw_schema, *rows), entity, **options)
    return [tuple(row) for row in result.collect()]


def test_products_are_trimmed_typed_and_active(frame):
    assert typed(frame, PRODUCTS, ("7", "  Desk lamp ", " Home  ", "24.90", "3")) == [
        (7, "Desk lamp", "Home", Decimal("24.90"), 3, True)
    ]


def test_customers_are_trimmed_typed_and_active(frame):
    row = (" 12 ", " Ines", "Moreau ", " ines@shop.test ", " France", "2025-03-04")
    assert typed(frame, CUSTOMERS, row) == [
        (12, "Ines", "Moreau", "ines@shop.test", "France", date(2025, 3, 4), True)
    ]


def test_orders_keep_the_case_of_the_status(frame):
    assert typed(frame, ORDERS, ("5", "12", "2025-03-05", "  Completed ")) == [
        (5, 12, date(2025, 3, 5), "Completed")
    ]


def test_order_items_are_typed(frame):
    assert typed(frame, ORDER_ITEMS, ("1", "5", "7", "2", "24.9")) == [
        (1, 5, 7, 2, Decimal("24.90"))
    ]


def test_unreadable_values_become_null(frame):
    integers = ["abc", "", "7.9", "99999999999", "1e3", None]
    rows = [(text, "1", "2025-01-01", "pending") for text in integers]
    assert [row[0] for row in typed(frame, ORDERS, *rows)] == [None] * len(rows)
    prices = ["free", "", "123456789.00", None]
    rows = [("1", "1", "1", "1", text) for text in prices]
    assert [row[4] for row in typed(frame, ORDER_ITEMS, *rows)] == [None] * len(rows)
    dates = ["05/01/2026", "soon", "", "2026-13-01", None]
    rows = [("1", "1", text, "pending") for text in dates]
    assert [row[2] for row in typed(frame, ORDERS, *rows)] == [None] * len(rows)


def test_accepted_spellings(frame):
    assert typed(frame, ORDERS, (" 7 ", "+8", "2026-1-5", "x"))[0][:3] == (7, 8, date(2026, 1, 5))
    assert typed(frame, ORDERS, ("7", "8", "2026-01-05T10:00:00", "x"))[0][2] == date(2026, 1, 5)
    assert typed(frame, ORDER_ITEMS, ("1", "1", "1", "1", "19.995"))[0][4] == Decimal("20.00")


def test_only_spaces_are_trimmed(frame):
    assert typed(frame, ORDERS, ("1", "1", "2025-01-01", " \tpending "))[0][3] == "\tpending"


def test_strict_fails_on_the_first_unreadable_value(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed(frame, ORDERS, ("abc", "1", "2025-01-01", "pending"), strict=True)


def test_other_columns_pass_through(frame):
    raw = frame(f"{ORDERS.raw_schema}, batch_id string", ("1", "2", "2025-01-01", "pending", "b"))
    assert standardize(raw, ORDERS).columns == [*ORDERS.columns, "batch_id"]


def test_wide_keys_hold_more_than_32_bits(frame):
    wide = ORDERS.with_wide_keys()
    assert typed(frame, wide, ("99999999999", "1", "2025-01-01", "pending"))[0][0] == 99999999999
    assert wide.columns["order_date"] == "date"


def test_values_that_cannot_be_read_at_first_sight_are_not_tried(spark, frame):
    texts = [None, "", ".", "1.", ".5", "7.9", " 1 ", "+1", "-1", "1e3", "E3", "x", "A-1", "n/a", "free", "NaN", "today", "2026-1-5"]
    texts += ["2020-01-01 ", "T2020-01-01", "99999999999", "123456789012.00", "19.995", "{1", "@1", "\u00e9", "\x7f1", "1 2", " x", "true"]
    rows = frame("v string", *[(t,) for t in texts])
    for kind in ("int", "bigint", "decimal(10,2)", "date"):
        read = rows.select(typed_column("v", kind).alias("now"), F.col("v").try_cast(kind).alias("plain"))
        assert read.where("NOT now <=> plain").count() == 0
        plan = read.select("now")._jdf.queryExecution().optimizedPlan().toString()
        assert " < A)" in plan and ("Contains" in plan) == (kind in ("int", "bigint"))
    numbers = frame("v decimal(10,2)", (Decimal("7.90"),))
    assert numbers.select(typed_column("v", "int")).collect() == [(7,)]


def test_numbers_out_of_range_become_null_without_being_raised(spark, frame):
    edges = ["2147483647", "-2147483648", "2147483648", "-2147483649", "99999999999999999999", " +2147483647 ", "0", None, "x", "7.9"]
    prices = ["99999999.99", "-99999999.99", "99999999.994", "99999999.995", "-99999999.995", "123456789012.00", "1e15", "1e40", " 1 ", None]
    raw = frame(ORDER_ITEMS.raw_schema, *[(edge, edge, edge, edge, price) for edge, price in zip(edges, prices, strict=True)])
    now = standardize(raw, ORDER_ITEMS)
    assert now.dtypes == list(ORDER_ITEMS.columns.items())
    plain = raw.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in ORDER_ITEMS.columns.items()])
    assert [tuple(row) for row in now.collect()] == [tuple(row) for row in plain.collect()]
    assert [row["order_id"] for row in now.collect()] == [2147483647, -2147483648, None, None, None, 2147483647, 0, None, None, None]
    plan = now._jdf.queryExecution().optimizedPlan().toString()
    # Each text is read once, as a type that holds what overflows the column's own.
    assert plan.count("try_cast") == len(ORDER_ITEMS.columns)
    assert plan.count("as bigint)") == 4 and "as decimal(18,2))" in plan


def test_numbers_out_of_range_fail_when_strict(frame):
    with pytest.raises(Exception, match="CAST_(INVALID_INPUT|OVERFLOW)"):
        typed(frame, ORDERS, ("2147483648", "1", "2025-01-01", "pending"), strict=True)

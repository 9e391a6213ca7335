from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PRODUCTS, batch_counts, error_counts
from tidemark import mark_unique, standardize, validate
from tidemark.operators.quality import invalid_rows, repeated_keys, valid_rows


def schema_of(entity):
    return ", ".join(f"{name} {kind}" for name, kind in entity.columns.items())


GOOD = {
    "products": (10, "Lamp", "Home", Decimal("5.00"), 1),
    "customers": (10, "Ines", "Moreau", "ines@shop.test", "France", date(2025, 1, 1)),
    "orders": (10, 1, date(2025, 1, 1), "pending"),
    "order_items": (10, 1, 1, 1, Decimal("5.00")),
}


def errors_of(frame, entity, *cases):
    """Errors of one good row per case, changed as the case says; keys differ."""
    rows = []
    for number, changes in enumerate(cases):
        row = dict(zip(entity.columns, GOOD[entity.name])) | {entity.key: 100 + number}
        rows.append((number, *(row | changes).values()))
    checked = validate(frame(f"case_number int, {schema_of(entity)}", *rows), entity).collect()
    assert all(row["is_valid"] == (row["quality_errors"] == []) for row in checked)
    return [row["quality_errors"] for row in sorted(checked, key=lambda row: row["case_number"])]


@pytest.mark.parametrize("name", list(ENTITIES))
def test_good_rows_and_null_rules(frame, name):
    entity = ENTITIES[name]
    cases = [{}] + [{column: None} for column in entity.columns]
    expected = [[]] + [[f"{column} is NULL"] for column in entity.columns]
    assert errors_of(frame, entity, *cases) == expected


VALUE_CASES = [
    (PRODUCTS, {"product_id": 0}, ["product_id <= 0"]),
    (PRODUCTS, {"product_id": -4}, ["product_id <= 0"]),
    (PRODUCTS, {"name": ""}, ["name is empty"]),
    (PRODUCTS, {"category": ""}, ["category is empty"]),
    (PRODUCTS, {"price": Decimal("-0.01")}, ["price < 0"]),
    (PRODUCTS, {"price": Decimal("0.00")}, []),
    (PRODUCTS, {"stock_quantity": -1}, ["stock_quantity < 0"]),
    (PRODUCTS, {"stock_quantity": 0}, []),
    (CUSTOMERS, {"customer_id": 0}, ["customer_id <= 0"]),
    (CUSTOMERS, {"first_name": ""}, ["first_name is empty"]),
    (CUSTOMERS, {"last_name": ""}, ["last_name is empty"]),
    (CUSTOMERS, {"country": ""}, ["country is empty"]),
    (CUSTOMERS, {"email": ""}, ["email is empty", "email format is invalid"]),
    (CUSTOMERS, {"email": "a b@c.d"}, ["email format is invalid"]),
    (CUSTOMERS, {"email": "a@b"}, ["email format is invalid"]),
    (CUSTOMERS, {"email": "a@b@c.d"}, ["email format is invalid"]),
    (ORDERS, {"order_id": 0}, ["order_id <= 0"]),
    (ORDERS, {"customer_id": -1}, ["customer_id <= 0"]),
    (ORDERS, {"status": ""}, ["status is empty", "status is invalid"]),
    (ORDERS, {"status": "Completed"}, ["status is invalid"]),
    (ORDERS, {"status": "cancelled"}, []),
    (ORDER_ITEMS, {"order_item_id": 0}, ["order_item_id <= 0"]),
    (ORDER_ITEMS, {"order_id": 0}, ["order_id <= 0"]),
    (ORDER_ITEMS, {"product_id": 0}, ["product_id <= 0"]),
    (ORDER_ITEMS, {"quantity": 0}, ["quantity <= 0"]),
    (ORDER_ITEMS, {"unit_price": Decimal("-1.00")}, ["unit_price < 0"]),
    (ORDER_ITEMS, {"unit_price": Decimal("0.00")}, []),
]


@pytest.mark.parametrize("name", list(ENTITIES))
def test_value_rules(frame, name):
    cases = [(changes, errors) for entity, changes, errors in VALUE_CASES if entity.name == name]
    assert len(cases) >= 5
    got = errors_of(frame, ENTITIES[name], *[changes for changes, _ in cases])
    assert got == [errors for _, errors in cases]


def test_errors_come_in_rule_order(frame):
    rows = [(0, None, None, "?"), (0, -1, date(2025, 1, 1), None)]
    checked = validate(frame(schema_of(ORDERS), *rows), ORDERS)
    assert {tuple(row["quality_errors"]) for row in checked.collect()} == {
        (
            "order_id is not unique",
            "order_id <= 0",
            "customer_id is NULL",
            "order_date is NULL",
            "status is invalid",
        ),
        ("order_id is not unique", "order_id <= 0", "customer_id <= 0", "status is NULL"),
    }


def test_rule_counts():
    assert {name: len(entity.rules) for name, entity in ENTITIES.items()} == {
        "products": 11,
        "customers": 13,
        "orders": 9,
        "order_items": 11,
    }


def flags(frame_, **options):
    marked = mark_unique(frame_, "k", **options)
    return sorted(((r["k"], r["v"], r["is_unique"]) for r in marked.collect()), key=repr)


def test_all_copies_are_marked_and_null_keys_are_unique(frame):
    rows = frame("k int, v string", (1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "d"), (None, "e"))
    expected = [
        (1, "a", True),
        (2, "b", False),
        (2, "b", False),
        (2, "c", False),
        (None, "d", True),
        (None, "e", True),
    ]
    assert flags(rows) == expected
    repeated = repeated_keys(rows, "k")
    assert [tuple(row) for row in repeated.collect()] == [(2, 3)]
    assert flags(rows, repeated=repeated) == expected
    assert flags(rows, repeated=repeated, broadcast_repeated=True) == expected


def test_uniqueness_of_text_keys(frame):
    assert flags(frame("k string, v string", ("x", "a"), ("x", "b"), ("", "c"))) == [
        ("", "c", True),
        ("x", "a", False),
        ("x", "b", False),
    ]


def test_no_rows_and_only_null_keys(frame):
    assert flags(frame("k int, v string")) == []
    assert flags(frame("k int, v string", (None, "a"), (None, "b"))) == [
        (None, "a", True),
        (None, "b", True),
    ]


def test_more_repeated_keys_than_the_broadcast_holds(spark):
    rows = spark.range(7000).select((F.col("id") % 3500).alias("k"), F.col("id").alias("v"))
    single = spark.range(10_000, 10_500).select(F.col("id").alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(single)
    for options in ({}, {"repeated": repeated_keys(rows, "k")}):
        counted = mark_unique(rows, "k", **options).groupBy("is_unique").count().collect()
        assert {row["is_unique"]: row["count"] for row in counted} == {False: 7000, True: 500}


def test_split_and_counts(frame):
    rows = frame(
        schema_of(ORDERS),
        (1, 1, date(2025, 1, 1), "pending"),
        (2, None, date(2025, 1, 1), "?"),
        (3, None, date(2025, 1, 1), "completed"),
    )
    checked = validate(rows, ORDERS)
    assert [row["order_id"] for row in valid_rows(checked).collect()] == [1]
    assert sorted(row["order_id"] for row in invalid_rows(checked).collect()) == [2, 3]
    assert tuple(batch_counts(checked).first()) == (3, 1, 2)
    assert {tuple(row) for row in error_counts(checked).collect()} == {
        ("customer_id is NULL", 2),
        ("status is invalid", 1),
    }


def test_repeated_keys_are_read_from_their_text_once(frame):
    keys = ["1", "1", "2", None, None, "x", "x", "2147483648", "2147483648"]
    raw = frame(f"{ORDERS.raw_schema}, batch_id string", *[(key, "1", "2025-01-01", "pending", "b") for key in keys])
    repeated = repeated_keys(standardize(raw, ORDERS), "order_id", "batch_id")
    assert [tuple(row) for row in repeated.collect()] == [(1, "b", 2)]
    plan = repeated._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 1

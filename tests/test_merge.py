import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import ORDERS, PRODUCTS, merge_incremental, merge_snapshot, soft_delete_missing
from tidemark.operators.merge import folded_changes, incremental_changes, missing_keys, snapshot_changes, unchanged_slices

PRODUCT = "product_id int, name string, price decimal(10,2), is_active boolean, batch_id string"
COMPARE = ("name", "price", "is_active")


def product(key, name, active, batch, price=None):
    return (key, name, Decimal(price or "1.00"), active, batch)


def keyed(result):
    rows = {row["product_id"]: tuple(row)[1:] for row in result.collect()}
    assert len(rows) == result.count()
    return {k: (r[0], r[2], r[3]) for k, r in rows.items()}


def test_snapshot_updates_inserts_and_soft_deletes(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, "desk", True, "b1"))
    source = frame(PRODUCT, product(1, "lamp XL", True, "b2"), product(3, "chair", True, "b2"))
    merged = merge_snapshot(target, source, source, "product_id", COMPARE)
    assert keyed(merged) == {
        1: ("lamp XL", True, "b2"),
        2: ("desk", False, "b1"),
        3: ("chair", True, "b2"),
    }
    assert merged.schema.simpleString() == target.schema.simpleString()


def test_unchanged_rows_keep_their_old_lineage(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, None, True, "b1"))
    source = frame(PRODUCT, product(1, "lamp", True, "b2"), product(2, None, True, "b2"))
    merged = merge_snapshot(target, source, source, "product_id", COMPARE)
    assert keyed(merged) == {1: ("lamp", True, "b1"), 2: (None, True, "b1")}


def test_a_value_that_becomes_null_is_a_change(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"))
    source = frame(PRODUCT, product(1, None, True, "b2"))
    assert keyed(merge_incremental(target, source, "product_id", COMPARE)) == {
        1: (None, True, "b2")
    }


def test_returning_entity_is_reactivated_without_other_change(frame):
    target = frame(PRODUCT, product(1, "lamp", False, "b1"))
    source = frame(PRODUCT, product(1, "lamp", True, "b2"))
    merged = merge_snapshot(target, source, source, "product_id", COMPARE)
    assert keyed(merged) == {1: ("lamp", True, "b2")}


def test_rejected_but_listed_entity_keeps_its_last_good_row(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, "desk", True, "b1"))
    source = frame(PRODUCT, product(1, "lamp", True, "b2"))
    listed = frame("product_id int", (1,), (2,), (2,), (None,))
    merged = merge_snapshot(target, source, listed, "product_id", COMPARE)
    assert keyed(merged)[2] == ("desk", True, "b1")


def test_empty_snapshot_deactivates_everything(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, "desk", False, "b0"))
    empty = frame(PRODUCT)
    merged = merge_snapshot(target, empty, empty, "product_id", COMPARE)
    assert keyed(merged) == {1: ("lamp", False, "b1"), 2: ("desk", False, "b0")}


def test_incremental_keeps_missing_rows(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, "desk", True, "b1"))
    source = frame(PRODUCT, product(1, "lamp", True, "b2", "2.00"), product(3, "mat", True, "b2"))
    for broadcast in (False, True):
        merged = merge_incremental(target, source, "product_id", COMPARE, broadcast)
        assert keyed(merged) == {
            1: ("lamp", True, "b2"),
            2: ("desk", True, "b1"),
            3: ("mat", True, "b2"),
        }


def test_source_columns_follow_the_target(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"))
    source = frame(
        "batch_id string, name string, is_active boolean, price double, product_id bigint",
        ("b2", "mat", True, 3.5, 9),
    )
    merged = merge_incremental(target, source, "product_id", COMPARE)
    assert merged.schema.simpleString() == target.schema.simpleString()
    assert keyed(merged)[9] == ("mat", True, "b2")


def test_soft_delete_alone(frame):
    target = frame(PRODUCT, product(1, "lamp", True, "b1"), product(2, "desk", True, "b1"))
    listed = frame("product_id int", (1,), (1,), (None,))
    assert keyed(soft_delete_missing(target, listed, "product_id")) == {
        1: ("lamp", True, "b1"),
        2: ("desk", False, "b1"),
    }
    assert [r[0] for r in missing_keys(target, listed, "product_id").collect()] == [2]


names = st.sampled_from(["a", "b", None])
states = st.dictionaries(st.integers(1, 8), st.tuples(names, st.booleans()), max_size=8)
deliveries = st.dictionaries(st.integers(1, 8), names, max_size=8)
SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@SLOW
@given(states, deliveries, st.sets(st.integers(1, 8)))
def test_snapshot_against_brute_force(frame, before, delivered, rejected):
    target = frame(PRODUCT, *[product(k, n, a, "b1") for k, (n, a) in before.items()])
    source = frame(PRODUCT, *[product(k, n, True, "b2") for k, n in delivered.items()])
    listed = set(delivered) | rejected
    ids = frame("product_id int", *[(k,) for k in sorted(listed)] * 2)

    expected = {k: (n, a, "b1") for k, (n, a) in before.items()}
    for k, n in delivered.items():
        if k not in before or before[k] != (n, True):
            expected[k] = (n, True, "b2")
    for k in set(before) - listed:
        expected[k] = (before[k][0], False, "b1")

    once = merge_snapshot(target, source, ids, "product_id", COMPARE)
    assert keyed(once) == expected
    assert keyed(merge_snapshot(once, source, ids, "product_id", COMPARE)) == expected


@SLOW
@given(states, deliveries, st.booleans())
def test_incremental_against_brute_force(frame, before, delivered, broadcast):
    target = frame(PRODUCT, *[product(k, n, a, "b1") for k, (n, a) in before.items()])
    source = frame(PRODUCT, *[product(k, n, True, "b2") for k, n in delivered.items()])
    expected = {k: (n, a, "b1") for k, (n, a) in before.items()}
    for k, n in delivered.items():
        if k not in before or before[k] != (n, True):
            expected[k] = (n, True, "b2")
    merged = merge_incremental(target, source, "product_id", COMPARE, broadcast)
    assert keyed(merged) == expected


@pytest.mark.parametrize("broadcast", [False, True])
def test_a_source_that_repeats_a_key_is_refused(frame, broadcast):
    schema = "order_id int, customer_id int, order_date date, status string"
    old, new = frame(schema, (1, 1, None, "a")), frame(schema, (1, 1, None, "b"), (1, 1, None, "c"))
    with pytest.raises(Exception, match="the source repeats order_id 1"):
        merge_incremental(old, new, "order_id", ORDERS.compare, broadcast_source=broadcast).collect()


def test_snapshots_refuse_repeated_and_unlisted_keys(frame):
    schema = "product_id int, name string, category string, price decimal(10,2), stock_quantity int, is_active boolean"
    row = (1, "a", "b", None, 1, True)
    old, one, two = frame(schema, row), frame(schema, row), frame(schema, row, row)
    with pytest.raises(Exception, match="the source repeats product_id 1"):
        merge_snapshot(old, two, one, "product_id", PRODUCTS.compare).collect()
    other = frame(schema, (2, "a", "b", None, 1, True))
    with pytest.raises(Exception, match="the snapshot does not list product_id 2"):
        merge_snapshot(old, other, one, "product_id", PRODUCTS.compare).collect()


# -- labels and folds -------------------------------------------------------------------------

STOCK = "product_id int, name string, category string, price decimal(10,2), stock_quantity int, is_active boolean, batch_id string"
COMPARED = ("name", "category", "price", "stock_quantity", "is_active")


def stocked(key, name, batch, active=True):
    return (key, name, "home", Decimal("1.00"), 1, active, batch)


def labelled(frame):
    return {r["product_id"]: (r["_change"], r["batch_id"], r["is_active"]) for r in frame.collect()}


def test_every_row_of_a_snapshot_merge_is_labelled(frame):
    target = frame(STOCK, *[stocked(k, "a", "old", k != 4 and k != 5) for k in range(1, 7)])
    source = frame(STOCK, stocked(1, "a", "new"), stocked(2, "b", "new"), stocked(4, "a", "new"), stocked(9, "a", "new"))
    listed = frame("product_id int", (1,), (2,), (4,), (9,), (6,), (6,), (None,))
    assert labelled(snapshot_changes(target, source, listed, "product_id", COMPARED)) == {
        1: ("same", "old", True),
        2: ("updated", "new", True),
        3: ("deactivated", "old", False),
        4: ("reactivated", "new", True),
        5: ("same", "old", False),
        6: ("same", "old", True),
        9: ("inserted", "new", True),
    }


@pytest.mark.parametrize("small", [True, False])
def test_every_row_of_an_upsert_is_labelled(frame, small):
    target = frame(STOCK, *[stocked(k, "a", "old") for k in (1, 2, 3)])
    source = frame(STOCK, stocked(1, "a", "new"), stocked(2, "b", "new"), stocked(9, "a", "new"))
    found = labelled(incremental_changes(target, source, "product_id", COMPARED, broadcast_source=small))
    assert {k: v[:2] for k, v in found.items()} == {1: ("same", "old"), 2: ("updated", "new"), 3: ("same", "old"), 9: ("inserted", "new")}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("snapshots", [True, False])
def test_folded_deliveries_equal_one_after_the_other(frame, seed, snapshots):
    draw = random.Random(seed)
    target = frame(STOCK, *[stocked(k, draw.choice("ab"), "old", draw.random() < 0.7 or not snapshots) for k in range(1, 9)])
    rows, listed, deleting, state = [], [], [], target
    for n in range(5):
        keys = draw.sample(range(1, 12), 6)
        new = [stocked(k, draw.choice("ab"), f"b{n}") for k in keys[:4]]
        deleting.append(draw.random() < 0.8)
        rows += [(*r, n) for r in new]
        listed += [(k, n) for k in keys for _ in range(draw.randint(1, 2))] + [(None, n)]
        source = frame(STOCK, *new)
        if snapshots and deleting[-1]:
            state = merge_snapshot(state, source, frame("product_id int", *[(k,) for k in keys]), "product_id", COMPARED)
        else:
            state = merge_incremental(state, source, "product_id", COMPARED)
    found = folded_changes(
        target, frame(f"{STOCK}, no int", *rows), "product_id", COMPARED, "no",
        frame("product_id int, no int", *listed) if snapshots else None, deleting,
    )
    assert sorted(map(tuple, found.drop("_change").collect())) == sorted(map(tuple, state.collect()))
    before = {r["product_id"]: tuple(r) for r in target.collect()}
    for row in found.collect():
        old, new = before.get(row["product_id"]), tuple(row)[:-1]
        flipped = "deactivated" if old and old[5] and not new[5] else "reactivated" if old and new[5] and not old[5] else None
        assert row["_change"] == ("inserted" if old is None else flipped or ("same" if old == new else "updated"))


def test_unchanged_slices_are_told_by_sums(frame):
    target = frame(STOCK, *[stocked(k, "a", "old", k != 13) for k in (1, 2, 11, 12, 13, 21, 31, 41)])
    source = frame(STOCK, *[stocked(k, "a", "new") for k in (1, 11, 12, 21, 51)], stocked(31, "b", "new"))
    rejected = frame("product_id int", (2,), (2,))
    slice_of = F.floor(F.col("product_id") / 10)
    found = unchanged_slices(target, source, slice_of, "product_id", COMPARED, rejected).collect()
    assert sorted(map(tuple, found)) == [(0, 2), (1, 3), (2, 1)]

"""Plans and task sizes: what must hold when one key carries a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from checks import feeds
from tidemark import (
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    batch_counts,
    category_performance,
    customer_metrics,
    daily_sales,
    error_counts,
    mark_unique,
    merge_incremental,
    merge_snapshot,
    not_yet_quarantined,
    product_performance,
    standardize,
    validate,
)
from tidemark.operators import quality
from tidemark.operators.quality import invalid_rows, repeated_keys, valid_rows
from tidemark.session import SETTINGS

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def plan_of(frame):
    """The executed plan as text, after all adaptive changes."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def rows_per_task(frame):
    sizes = frame.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted(row["count"] for row in sizes)


@pytest.fixture
def skewed(spark):
    """One key holds half of the rows, NULL a quarter, and the rest is unique."""
    rows = spark.range(0, 40_000, numPartitions=8)
    key = F.when(F.col("id") % 4 < 2, -7).when(F.col("id") % 4 == 2, None).otherwise(F.col("id"))
    return rows.select(key.cast("int").alias("k"), F.col("id").alias("v"))


SMALL_SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "1KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "1KB",
    "spark__sql__shuffle__partitions": "8",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.mark.parametrize("given", [False, True])
def test_no_task_gathers_a_hot_or_missing_key(skewed, with_settings, given):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    marked = mark_unique(skewed, "k", repeated_keys(skewed, "k") if given else None)
    assert "skew=true" in plan_of(marked)
    counts = marked.groupBy("is_unique").count().collect()
    assert {r["is_unique"]: r["count"] for r in counts} == {False: 20_000, True: 20_000}
    # No aggregation on top: it would bring rows of a key together again.
    sizes = marked.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < 2 * 40_000 / 8


def test_rows_are_read_once_when_many_keys_repeat(skewed, with_settings):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    marked = mark_unique(skewed, "k", repeated_keys(skewed, "k"), many_repeated=True)
    assert plan_of(marked).count("Range (") == 2  # the keys, and the rows
    counts = marked.groupBy("is_unique").count().collect()
    assert {r["is_unique"]: r["count"] for r in counts} == {False: 20_000, True: 20_000}
    sizes = marked.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < 2 * 40_000 / 8


def test_many_warm_keys_are_marked_alike(spark, with_settings):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    rows = spark.range(0, 50_000, numPartitions=8).select((F.col("id") % 5000).cast("int").alias("k"), "id")
    marked = mark_unique(rows, "k")
    assert marked.where("NOT is_unique").count() == 50_000
    sizes = marked.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(sizes) < 2 * 50_000 / 8


def test_rows_whose_key_does_not_repeat_are_not_moved(spark, with_settings):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    rows = spark.range(0, 40_000, numPartitions=8).select(F.when(F.col("id") < 39_000, F.col("id")).otherwise(7).cast("int").alias("k"), "id")
    marked = mark_unique(rows, "k")
    plan = plan_of(marked)
    assert "Window" not in plan and "Subquery" in plan and "Union" in plan
    assert marked.where("NOT is_unique").count() == 1001
    moved = marked._jdf.queryExecution().executedPlan()
    moved.executeCollect()
    assert written_rows(marked) < 40_000 + 5_000  # the keys to be counted, then little more than the copies


def written_rows(frame):
    """Rows that all shuffles of a frame write, once it ran."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    found, todo = 0, [execution.executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name == "ShuffleQueryStage":
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_the_filter_of_repeated_keys_is_exact_with_any_number_of_them(spark, with_settings, monkeypatch):
    with_settings(**NO_BROADCAST)
    monkeypatch.setattr(quality, "FILTER_BITS", 128)
    rows = spark.range(0, 3000).select((F.col("id") % 2500).cast("int").alias("k"), (F.col("id") % 5).alias("b"), "id")
    assert mark_unique(rows, "k").where("NOT is_unique").count() == 1000
    within = {(r["k"], r["b"]) for r in mark_unique(rows, "k", within=["b"]).where("NOT is_unique").collect()}
    assert within == {(k, k % 5) for k in range(500)}
    assert mark_unique(rows, "k", within=["id"]).where("NOT is_unique").count() == 0


@pytest.fixture
def item_texts(spark):
    """Order items as text with faults, each value a longer expression; every fifth key repeats."""
    lines = spark.range(0, 3000, numPartitions=4).selectExpr(
        "id % 2500 AS l_orderkey", "1 AS l_linenumber", "id % 7 AS l_partkey", "CAST(id % 9 + 1 AS double) AS l_quantity", "CAST(id AS double) AS l_extendedprice"
    )
    return lines.selectExpr(*[f"{text} AS {name}" for name, text in feeds.RAW_ITEMS.columns.items()])


@pytest.mark.parametrize("most", [quality.MOST_FILTERED, 10])
def test_checks_of_texts_are_compiled(item_texts, with_settings, monkeypatch, most):
    with_settings(spark__sql__codegen__fallback="false", **NO_BROADCAST)  # what cannot be compiled fails
    monkeypatch.setattr(quality, "MOST_FILTERED", most)
    checked = validate(standardize(item_texts, ORDER_ITEMS), ORDER_ITEMS)
    rows = checked.collect()
    n_valid = sum(row["is_valid"] for row in rows)
    assert len(rows) == 3000 and 0 < n_valid < 3000
    assert tuple(batch_counts(checked).first()) == (3000, n_valid, 3000 - n_valid)
    assert valid_rows(checked).count() == n_valid and invalid_rows(checked).count() == 3000 - n_valid
    errors = [error for row in rows for error in row["quality_errors"]]
    assert {tuple(row) for row in error_counts(checked).collect()} == {(error, errors.count(error)) for error in errors}


@pytest.mark.parametrize("count", [batch_counts, error_counts, valid_rows, invalid_rows])
def test_checks_do_not_filter_by_texts_at_the_source(item_texts, count):
    plan = count(validate(standardize(item_texts, ORDER_ITEMS), ORDER_ITEMS))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" in plan
    assert not [line for line in plan.split("\n") if re.search(r"^[\s:+-]*Filter .*try_cast", line)]


def test_a_filter_that_would_be_full_is_not_asked(spark, with_settings, monkeypatch):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    key = F.when(F.col("id") % 4 == 3, None).otherwise(F.col("id") % 2000).cast("int")
    rows = spark.range(0, 40_000, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"))
    single = spark.range(5000, 6000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(single)
    for most, least_left in ((1499, 0), (1500, 10_900)):  # 1,500 keys repeat
        monkeypatch.setattr(quality, "MOST_FILTERED", most)
        marked = mark_unique(rows, "k")
        plan = plan_of(marked)
        assert "ReusedExchange" in plan  # keys are read and counted once, for the filter and for the join
        counts = marked.groupBy("is_unique").count().collect()
        assert {r["is_unique"]: r["count"] for r in counts} == {False: 30_000, True: 11_000}
        assert marked.where("k IS NULL AND is_unique").count() == 10_000
        sizes = marked.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        left_in_place, n_moved = sum(sizes[: rows.rdd.getNumPartitions()]), 41_000 - 11_000 * (least_left > 0)
        assert least_left <= left_in_place <= 41_000 - n_moved
        assert max(sizes[rows.rdd.getNumPartitions() :]) < 2 * n_moved / 8


def test_rejected_rows_are_matched_without_gathering(spark, with_settings):
    with_settings(**SMALL_SKEW, **NO_BROADCAST)
    rows = spark.range(0, 40_000, numPartitions=8).select(
        F.lit("b").alias("batch_id"),
        F.when(F.col("id") % 2 == 0, F.col("id")).cast("int").alias("order_id"),
        F.col("id").alias("copy"),
    )
    stored = rows.where("order_id % 4 = 0")
    new = not_yet_quarantined(rows, stored, "order_id")
    assert "skew=true" in plan_of(new)
    assert new.count() == 30_000
    assert not_yet_quarantined(rows, rows, "order_id").count() == 0


@pytest.fixture
def skewed_shop(spark):
    """One order holds half of all items, and one product most of them."""
    orders = spark.range(1, 4001).select(
        F.col("id").cast("int").alias("order_id"),
        (F.col("id") % 10).cast("int").alias("customer_id"),
        F.expr("date_add(DATE '2025-01-01', CAST(id % 1 AS int))").alias("order_date"),
        F.lit("completed").alias("status"),
    )
    items = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").cast("int").alias("order_item_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 4000 + 1).cast("int").alias("order_id"),
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 50 + 1).cast("int").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit("1.00").cast("decimal(10,2)").alias("unit_price"),
    )
    products = spark.range(1, 51).select(
        F.col("id").cast("int").alias("product_id"), F.lit("p").alias("name"), F.expr("concat('c', id % 1)").alias("category")
    )
    customers = spark.range(10).select(
        F.col("id").cast("int").alias("customer_id"),
        *[F.lit("x").alias(name) for name in ("first_name", "last_name", "country")],
    )
    return orders, items, products, customers


def test_a_hot_order_or_product_is_split_over_tasks(skewed_shop, with_settings):
    orders, items, products, customers = skewed_shop
    with_settings(
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        **NO_BROADCAST,
    )
    for report in (
        daily_sales(orders, items),
        product_performance(orders, items, products),
        category_performance(orders, items, products),
        customer_metrics(orders, items, customers),
    ):
        assert "skew=true" in plan_of(report)
    assert tuple(daily_sales(orders, items).first())[1:3] == (2001, 60_000)
    assert tuple(category_performance(orders, items, products).first())[:3] == ("c0", 2001, 60_000)
    assert product_performance(orders, items, products).agg(F.sum("revenue")).first()[0] == 60_000


def test_a_hot_group_is_summed_per_order_before_it_travels(skewed_shop):
    orders, items, products, customers = skewed_shop
    for report, group in (
        (daily_sales(orders, items), "order_date"),
        (product_performance(orders, items, products), "product_id"),
        (category_performance(orders, items, products), "category"),
        (customer_metrics(orders, items, customers), "customer_id"),
    ):
        plan = plan_of(report)
        assert re.search(rf"HashAggregate\(keys=\[{group}#\d+, order_id#\d+\], .*partial_sum", plan)


def test_reports_read_only_what_they_need(spark, skewed_shop, tmp_path):
    orders, items, products, _ = skewed_shop
    for name, frame in (("orders", orders), ("items", items), ("products", products)):
        frame.withColumn("unused", F.lit("x")).write.parquet(str(tmp_path / name))
    orders, items, products = (
        spark.read.parquet(str(tmp_path / name)) for name in ("orders", "items", "products")
    )
    for report in (daily_sales(orders, items), category_performance(orders, items, products)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(status,completed)" in plan
        assert "unused" not in plan and "order_item_id" not in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_merges_move_each_side_once(frame, with_settings):
    with_settings(**NO_BROADCAST)
    schema = "product_id int, name string, category string, price decimal(10,2), stock_quantity int, is_active boolean"
    target, source = frame(schema), frame(schema)
    merged = merge_snapshot(target, source, source, "product_id", PRODUCTS.compare)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4  # target, source, listed keys for both
    merged = merge_incremental(target, source, "product_id", PRODUCTS.compare)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_small_batch_leaves_the_target_where_it_is(frame):
    schema = "order_id int, customer_id int, order_date date, status string"
    merged = merge_incremental(
        frame(schema), frame(schema), "order_id", ORDERS.compare, broadcast_source=True
    )
    left, added = merged._jdf.queryExecution().executedPlan().toString().split("Union")[1].split(
        "\n", 1
    )[1].split("BroadcastHashJoin", 1)
    assert "Exchange hashpartitioning" not in left


def test_no_python_runs_in_tasks(frame):
    rows = frame(ORDERS.raw_schema, ("1", "1", "2025-01-01", "pending"))
    plan = validate(standardize(rows, ORDERS), ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_rules_are_compiled_with_what_is_around_them(spark):
    raw = spark.range(10).select(*[F.col("id").cast("string").alias(c) for c in ORDERS.columns])
    plan = plan_of(validate(standardize(raw, ORDERS), ORDERS, spark.createDataFrame([], "order_id int"), broadcast_repeated=True))
    assert "lambda" not in plan and not re.search(r"^[\s:+-]*Project", plan, re.M)


def test_partitioned_writes_do_not_sort(spark, tmp_path, with_settings):
    with_settings(**{name.replace(".", "__"): value for name, value in SETTINGS.items()})
    spark.sql(f"CREATE TABLE checked_rows (k int, is_valid boolean) USING parquet PARTITIONED BY (is_valid) LOCATION '{tmp_path}/t'")
    try:
        plan = spark.sql("EXPLAIN INSERT INTO checked_rows SELECT CAST(id AS int), id % 2 = 0 FROM range(10)").first()[0]
    finally:
        spark.sql("DROP TABLE checked_rows")
    assert "InsertInto" in plan and "Sort" not in plan

"""Every operator of the library, run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark as tm
from checks import feeds
from tidemark.operators.control import latest_states, plan_files
from tidemark.operators.merge import CHANGE, CHANGES, incremental_changes, missing_keys, snapshot_changes
from tidemark.operators.quality import invalid_rows, repeated_keys, valid_rows
from tidemark.plans.jobs import read_report, read_silver
from tidemark.sources.control_log import read_events
from tidemark.sources.csv import ingest, read_raw
from tidemark.sources.fingerprint import content_hash, file_sha256
from tidemark.sources.tables import read_batches
from tidemark.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

SHOWN = {
    name: [*entity.columns, *(["is_active"] if entity.snapshot else [])]
    for name, entity in tm.ENTITIES.items()
}


def _errors():
    return F.array_join("quality_errors", "; ").alias("errors")


def _frames(spark: SparkSession, sf_dir: str, *wanted: feeds.Feed) -> list[DataFrame]:
    tm.tune(spark)
    return [feed.frame(spark, sf_dir) for feed in wanted]


def _over(operator: Callable[..., DataFrame], *wanted: feeds.Feed) -> Query:
    """A query that applies ``operator`` to the frames of some feeds."""
    return lambda spark, sf_dir: operator(*_frames(spark, sf_dir, *wanted))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- quality ----------------------------------------------------------------


def _checked(raw: DataFrame, entity: tm.Entity) -> DataFrame:
    return tm.validate(tm.standardize(raw, entity), entity)


def _quality_queries(entity: tm.Entity) -> dict[str, Query]:
    name, raw, shown = entity.name, feeds.RAW[entity.name], SHOWN[entity.name]
    return {
        f"standardize_{name}": _over(lambda r: tm.standardize(r, entity), raw),
        f"validate_{name}": _over(
            lambda r: _checked(r, entity).select(*shown, "is_unique", _errors(), "is_valid"), raw
        ),
        f"valid_{name}": _over(lambda r: valid_rows(_checked(r, entity)).select(*shown), raw),
        f"invalid_{name}": _over(
            lambda r: invalid_rows(_checked(r, entity)).select(*shown, _errors()), raw
        ),
    }


def _per_entity(spark: SparkSession, sf_dir: str, measure) -> DataFrame:
    tm.tune(spark)
    return _union(
        [
            measure(
                _checked(feeds.RAW[name].frame(spark, sf_dir), entity).withColumn(
                    "entity", F.lit(name)
                ),
                "entity",
            )
            for name, entity in tm.ENTITIES.items()
        ]
    )


def _unique_customer_of_order(raw: DataFrame) -> DataFrame:
    orders = tm.standardize(raw, tm.ORDERS)
    return tm.mark_unique(orders, "customer_id").select("order_id", "customer_id", "is_unique")


# --- merges -----------------------------------------------------------------


def _snapshot(entity: tm.Entity):
    return lambda target, source, ids: tm.merge_snapshot(
        target, source, ids, entity.key, entity.compare
    )


def _upsert(entity: tm.Entity, **options):
    return lambda target, source: tm.merge_incremental(
        target, source, entity.key, entity.compare, **options
    )


def _snapshot_changes(entity: tm.Entity):
    return lambda target, source, ids: snapshot_changes(
        target, source, ids, entity.key, entity.compare
    ).withColumnRenamed(CHANGE, "change")


def _upsert_changes(target: DataFrame, source: DataFrame) -> DataFrame:
    changes = incremental_changes(target, source, tm.ORDERS.key, tm.ORDERS.compare)
    return changes.withColumnRenamed(CHANGE, "change")


def _snapshot_with_rejected(target: DataFrame, source: DataFrame, rejected: DataFrame) -> DataFrame:
    """The snapshot lists rows beyond its valid ones, so their entities stay as they are."""
    listed = source.select("product_id").union(rejected.select("product_id"))
    return _snapshot(tm.PRODUCTS)(target, source, listed)


def _snapshot_twice(target: DataFrame, source: DataFrame, ids: DataFrame) -> DataFrame:
    merge = _snapshot(tm.PRODUCTS)
    return merge(merge(target, source, ids), source, ids)


def _upsert_twice(target: DataFrame, source: DataFrame) -> DataFrame:
    merge = _upsert(tm.ORDERS)
    return merge(merge(target, source), source)


def _upsert_items(target: DataFrame, source: DataFrame) -> DataFrame:
    columns = [*SHOWN["order_items"], "batch_id"]
    target, source = (
        valid_rows(tm.validate(rows, tm.ORDER_ITEMS)).select(*columns) for rows in (target, source)
    )
    return _upsert(tm.ORDER_ITEMS)(target, source)


# --- quarantine and control -------------------------------------------------


def _quarantine(stored_batch: str, null_safe: bool):
    def query(all_raw: DataFrame, stored_raw: DataFrame) -> DataFrame:
        rejected, stored = (
            invalid_rows(_checked(raw, tm.ORDERS)).withColumn("batch_id", F.lit(batch))
            for raw, batch in ((all_raw, "today"), (stored_raw, stored_batch))
        )
        new = tm.not_yet_quarantined(rejected, stored, "order_id", null_safe)
        return new.select(*SHOWN["orders"], _errors())

    return query


# --- files ------------------------------------------------------------------


def write_csv(rows: DataFrame, path: str) -> None:
    (
        rows.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_lines(lines: DataFrame, entity: tm.Entity, path: str) -> None:
    """Whole lines (one column) below the entity's header, in as many part files as tasks."""
    (
        lines.toDF(",".join(entity.columns))
        .write.option("header", True)
        .option("sep", "\u0001")  # neither splits nor quotes a line
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _csv_roundtrip(entity: tm.Entity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = Workspace(spark, "csv", keep=True)
        [raw] = _frames(spark, sf_dir, feeds.RAW[entity.name])
        write_csv(raw, f"{work.path}/{entity.name}")
        return read_raw(spark, f"{work.path}/{entity.name}", entity)

    return query


def _misfit_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of orders in which some rows end early and some go on, loaded as a batch that tells them."""
    work = Workspace(spark, "misfits", keep=True)
    [rows] = _frames(spark, sf_dir, feeds.ORDERS)
    whole = F.concat_ws(",", *[F.col(c).cast("string") for c in tm.ORDERS.columns])
    line = F.when(F.col("order_id") % 50 == 1, F.concat_ws(",", "order_id", "customer_id"))
    line = line.when(F.col("order_id") % 50 == 2, F.concat(whole, F.lit(",more"))).otherwise(whole)
    write_lines(rows.select(line.alias("line")), tm.ORDERS, f"{work.path}/file")
    entity, layout = tm.ORDERS.with_misfits(), tm.Layout(f"{work.path}/lake")
    tm.run_entity_batch(spark, entity, f"{work.path}/file", layout)
    stored = spark.read.parquet(layout.quarantine(entity))
    good = read_silver(spark, layout, entity).select(*SHOWN["orders"], F.lit("").alias("errors"), F.lit(None).cast("string").alias("line"))
    return good.union(stored.select(*SHOWN["orders"], _errors(), F.col("misfit").alias("line")))


def _bronze_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of orders, one of them ingested twice."""
    work = Workspace(spark, "bronze", keep=True)
    bronze = f"{work.path}/bronze"
    for label, deliveries in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND)):
        [raw] = _frames(spark, sf_dir, deliveries["orders"])
        write_csv(raw, f"{work.path}/{label}")
        ingest(spark, f"{work.path}/{label}", tm.ORDERS, bronze, f"orders-{label}")
    ingest(spark, f"{work.path}/second", tm.ORDERS, bronze, "orders-second")
    return read_batches(spark, bronze, tm.ORDERS.bronze_schema).select(
        *tm.ORDERS.columns,
        "batch_id",
        F.col("source_file").endswith(".csv").alias("has_source"),
        F.col("ingestion_timestamp").isNotNull().alias("has_time"),
    )


def _content_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which CSV variants of the customer file, with headers, count as the content of the first."""
    work = Workspace(spark, "identity", keep=True)
    [rows] = _frames(spark, sf_dir, feeds.RAW["customers"])
    other = F.when(F.trim("country") == "BUILDING", "OTHER").otherwise(F.col("country"))
    variants = {
        "one part": rows.coalesce(1),
        "two parts": rows.repartition(2),
        "three parts": rows.repartition(3, "country"),
        "one country renamed": rows.withColumn("country", other).coalesce(1),
        "every row twice": rows.union(rows).repartition(2),
    }
    hashes, written = {}, []
    for name, variant in variants.items():
        path = f"{work.path}/{name.replace(' ', '_')}"
        write_csv(variant, path)
        hashes[name] = content_hash(spark, path, tm.CUSTOMERS)
        lines = read_raw(spark, path, tm.CUSTOMERS).agg(F.count(F.lit(1)).alias("lines"))
        same = F.lit(hashes[name] == hashes["one part"]).alias("same_content")
        written.append(lines.select(F.lit(name).alias("variant"), same, "lines"))
    return _union(written)


def _file_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of one text file for each nation's customers."""
    work = Workspace(spark, "bytes", keep=True)
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").repartition("c_nationkey")
    lines = rows.sortWithinPartitions("c_nationkey", "c_custkey").selectExpr(
        "concat_ws(',', c_custkey, c_name, c_mktsegment) AS value", "c_nationkey AS nation"
    )
    lines.write.partitionBy("nation").text(work.path + "/lines")
    nation = F.regexp_extract("path", r"nation=(\d+)/", 1).cast("int").alias("nation")
    return file_sha256(spark, f"{work.path}/lines/*").select(nation, "length", "sha256")


# --- whole jobs -------------------------------------------------------------

_lakes: dict[tuple[str, str], tuple[tm.Layout, dict[str, str]]] = {}


def _lake(spark: SparkSession, sf_dir: str) -> tuple[tm.Layout, dict[str, str]]:
    """A lake that received both deliveries, and the second one again.

    Returns its layout and the delivery of every batch id. Built once per
    application and data folder, for all queries that look at its tables.
    """
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _lakes:
        work = Workspace(spark, "lake", keep=True)
        layout, delivery_of = tm.Layout(f"{work.path}/lake"), {}
        for label, deliveries in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND)):
            sources = {}
            for name, feed in deliveries.items():
                sources[name] = f"{work.path}/{label}/{name}"
                write_csv(feed.frame(spark, sf_dir), sources[name])
            results = tm.refresh(spark, sources, layout)
            delivery_of |= {result.batch_id: label for result in results.values()}
        again = tm.refresh(spark, sources, layout)
        assert all(result.skipped for result in again.values())
        _lakes[at] = (layout, delivery_of)
    return _lakes[at]


def _delivery(delivery_of: dict[str, str]):
    pairs = [F.lit(part) for pair in delivery_of.items() for part in pair]
    return F.create_map(*pairs)[F.col("batch_id")].alias("delivery")


def _silver(entity: tm.Entity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout, delivery_of = _lake(spark, sf_dir)
        return read_silver(spark, layout, entity).select(
            *SHOWN[entity.name], _delivery(delivery_of)
        )

    return query


def _quarantined(entity: tm.Entity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout, delivery_of = _lake(spark, sf_dir)
        return spark.read.parquet(layout.quarantine(entity)).select(
            *SHOWN[entity.name], _errors(), _delivery(delivery_of)
        )

    return query


def _report(name: str) -> Query:
    return lambda spark, sf_dir: read_report(spark, _lake(spark, sf_dir)[0], name)


def _logged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, delivery_of = _lake(spark, sf_dir)
    return spark.read.parquet(layout.batch_counts).select(
        "entity", _delivery(delivery_of), "total_rows", "valid_rows", "invalid_rows"
    )


def _logged_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, delivery_of = _lake(spark, sf_dir)
    return spark.read.parquet(layout.error_counts).select(
        F.substring_index("batch_id", "-", 1).alias("entity"),
        _delivery(delivery_of),
        "error",
        "row_count",
    )


def _logged_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, delivery_of = _lake(spark, sf_dir)
    return read_events(spark, layout.control).select("entity", _delivery(delivery_of), "status")


def _logged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, delivery_of = _lake(spark, sf_dir)
    return spark.read.parquet(layout.change_counts).select("entity", _delivery(delivery_of), *CHANGES)


def _folded(entity: tm.Entity) -> Query:
    """Both deliveries of an entity, and the second once more under another name, as one run."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        work = Workspace(spark, "folded", keep=True)
        layout, sources = tm.Layout(f"{work.path}/lake"), []
        for label, deliveries in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND)):
            sources.append(f"{work.path}/{label}")
            write_csv(deliveries[entity.name].frame(spark, sf_dir), sources[-1])
        sources.append(f"{work.path}/again")
        write_csv(feeds.RAW_SECOND[entity.name].frame(spark, sf_dir), sources[-1])
        results = tm.run_entity_batches(spark, entity, sources, layout)
        assert [result.skipped for result in results] == [False, False, True]
        delivery_of = {result.batch_id: label for result, label in zip(results, ("first", "second"))}
        return read_silver(spark, layout, entity).select(*SHOWN[entity.name], _delivery(delivery_of))

    return query


def _arriving_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in a folder, taken up by the stream in one trigger, each as a batch."""
    work = Workspace(spark, "arrivals", keep=True)
    [raw] = _frames(spark, sf_dir, feeds.RAW_ORDERS)
    write_csv(raw.repartition(3, "status"), f"{work.path}/inbox")
    layout = tm.Layout(f"{work.path}/lake")
    stream = tm.process_arrivals(
        spark, tm.ORDERS, f"{work.path}/inbox", layout, f"{work.path}/progress"
    )
    stream.awaitTermination()
    return read_silver(spark, layout, tm.ORDERS).select(*SHOWN["orders"])


# --- the queries ------------------------------------------------------------


def all_queries() -> dict[str, Query]:
    f = feeds
    queries: dict[str, Query] = {
        "daily_sales": _over(tm.daily_sales, f.ORDERS, f.ITEMS),
        "product_performance": _over(tm.product_performance, f.ORDERS, f.ITEMS, f.PRODUCTS),
        "category_performance": _over(tm.category_performance, f.ORDERS, f.ITEMS, f.PRODUCTS),
        "customer_metrics": _over(tm.customer_metrics, f.ORDERS, f.ITEMS, f.CUSTOMERS),
        "sales_lines": _over(tm.sales_lines, f.ORDERS, f.ITEMS),
        "daily_sales_orders_without_items": _over(
            tm.daily_sales, f.ORDERS, f.ITEMS.but(where="l_returnflag = 'N'")
        ),
        "product_performance_unknown_products": _over(
            tm.product_performance, f.ORDERS, f.ITEMS, f.PRODUCTS.but(where="p_size <= 25")
        ),
        "category_performance_unknown_products": _over(
            tm.category_performance, f.ORDERS, f.ITEMS, f.PRODUCTS.but(where="p_size <= 25")
        ),
        "customer_metrics_unknown_customers": _over(
            tm.customer_metrics, f.ORDERS, f.ITEMS, f.CUSTOMERS.but(where="c_acctbal > 0")
        ),
        "product_performance_repeated_products": _over(
            tm.product_performance, f.ORDERS, f.ITEMS, f.REPEATED_PRODUCTS
        ),
        "unique_item_ids": _over(
            lambda items: tm.mark_unique(items, "order_item_id").select(
                "order_item_id", "quantity", "unit_price", "is_unique"
            ),
            f.ITEMS,
        ),
        "repeated_item_ids": _over(lambda items: repeated_keys(items, "order_item_id"), f.ITEMS),
        "unique_customer_of_order": _over(_unique_customer_of_order, f.RAW_ORDERS),
    }
    for entity in tm.ENTITIES.values():
        queries |= _quality_queries(entity)
    queries |= {
        "batch_counts": lambda spark, sf_dir: _per_entity(spark, sf_dir, tm.batch_counts),
        "error_counts": lambda spark, sf_dir: _per_entity(spark, sf_dir, tm.error_counts),
        "merge_changes_products": _over(
            _snapshot_changes(tm.PRODUCTS), f.PRODUCTS_BEFORE, f.PRODUCTS_NEXT, f.PRODUCTS_LISTED
        ),
        "merge_changes_customers": _over(
            _snapshot_changes(tm.CUSTOMERS), f.CUSTOMERS_BEFORE, f.CUSTOMERS_NEXT, f.CUSTOMERS_NEXT
        ),
        "merge_changes_orders": _over(_upsert_changes, f.ORDERS_BEFORE, f.ORDERS_NEXT),
        "merge_snapshot_products": _over(
            _snapshot(tm.PRODUCTS), f.PRODUCTS_BEFORE, f.PRODUCTS_NEXT, f.PRODUCTS_LISTED
        ),
        "merge_snapshot_twice": _over(
            _snapshot_twice, f.PRODUCTS_BEFORE, f.PRODUCTS_NEXT, f.PRODUCTS_LISTED
        ),
        "merge_snapshot_customers": _over(
            _snapshot(tm.CUSTOMERS), f.CUSTOMERS_BEFORE, f.CUSTOMERS_NEXT, f.CUSTOMERS_NEXT
        ),
        "merge_snapshot_reactivates": _over(
            _snapshot(tm.PRODUCTS),
            f.PRODUCTS_BEFORE.but(is_active="FALSE"),
            f.PRODUCTS_NEXT,
            f.PRODUCTS_LISTED,
        ),
        "merge_snapshot_keeps_rejected": _over(
            _snapshot_with_rejected, f.PRODUCTS_BEFORE, f.PRODUCTS_NEXT, f.PRODUCTS_BEFORE
        ),
        "merge_snapshot_of_nothing": _over(
            lambda target, source: _snapshot(tm.PRODUCTS)(target, source, source),
            f.PRODUCTS_BEFORE,
            f.PRODUCTS_NEXT.but(where="p_size > 1000000"),
        ),
        "merge_incremental_orders": _over(_upsert(tm.ORDERS), f.ORDERS_BEFORE, f.ORDERS_NEXT),
        "merge_incremental_orders_small_batch": _over(
            _upsert(tm.ORDERS, broadcast_source=True), f.ORDERS_BEFORE, f.ORDERS_NEXT
        ),
        "merge_incremental_twice": _over(_upsert_twice, f.ORDERS_BEFORE, f.ORDERS_NEXT),
        "merge_incremental_order_items": _over(_upsert_items, f.ITEMS_BEFORE, f.ITEMS_NEXT),
        "merge_incremental_first_load": _over(
            _upsert(tm.ORDERS), f.ORDERS_BEFORE.but(where="FALSE"), f.ORDERS_NEXT
        ),
        "soft_delete_missing": _over(
            lambda target, ids: tm.soft_delete_missing(target, ids, "product_id"),
            f.PRODUCTS_BEFORE,
            f.PRODUCTS_LISTED,
        ),
        "missing_products": _over(
            lambda target, ids: missing_keys(target, ids, "product_id"),
            f.PRODUCTS_BEFORE,
            f.PRODUCTS_LISTED,
        ),
        "quarantine_new_rows": _over(
            _quarantine("today", True), f.RAW_ORDERS, f.RAW_FIRST["orders"]
        ),
        "quarantine_plain_equality": _over(
            _quarantine("today", False), f.RAW_ORDERS, f.RAW_FIRST["orders"]
        ),
        "quarantine_other_batch": _over(
            _quarantine("yesterday", True), f.RAW_ORDERS, f.RAW_FIRST["orders"]
        ),
        "latest_file_states": _over(
            lambda events: latest_states(events).drop("processed_at"), f.FILE_EVENTS
        ),
        "files_to_process": _over(plan_files, f.ARRIVED_FILES, f.FILE_EVENTS),
        "bronze_history": _bronze_history,
        "misfit_orders": _misfit_orders,
        "content_identity": _content_identity,
        "file_bytes": _file_bytes,
        "logged_batch_counts": _logged_counts,
        "logged_error_counts": _logged_errors,
        "logged_file_states": _logged_states,
        "logged_change_counts": _logged_changes,
        "arriving_orders": _arriving_orders,
    }
    for name, entity in tm.ENTITIES.items():
        queries[f"csv_{name}"] = _csv_roundtrip(entity)
        queries[f"silver_{name}"] = _silver(entity)
        queries[f"folded_{name}"] = _folded(entity)
        queries[f"quarantine_{name}"] = _quarantined(entity)
    for name in ("daily_sales", "product_performance", "category_performance", "customer_metrics"):
        queries[f"refreshed_{name}"] = _report(name)
    return queries

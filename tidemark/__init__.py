"""Layered batch analytics on Spark: raw CSV -> bronze -> silver -> reports."""

from tidemark.contracts import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PRODUCTS, Entity
from tidemark.operators.merge import merge_incremental, merge_snapshot, soft_delete_missing
from tidemark.operators.quality import batch_counts, error_counts, mark_unique, validate
from tidemark.operators.quarantine import not_yet_quarantined
from tidemark.operators.standardize import standardize
from tidemark.plans.jobs import Layout, read_report, refresh, refresh_reports, run_entity_batch, run_entity_batches
from tidemark.plans.reports import (
    build_reports,
    category_performance,
    customer_metrics,
    daily_sales,
    product_performance,
    sales_lines,
)
from tidemark.session import build_session, tune
from tidemark.streaming.arrivals import process_arrivals

__all__ = [
    "CUSTOMERS",
    "ENTITIES",
    "ORDERS",
    "ORDER_ITEMS",
    "PRODUCTS",
    "Entity",
    "Layout",
    "batch_counts",
    "build_reports",
    "build_session",
    "category_performance",
    "customer_metrics",
    "daily_sales",
    "error_counts",
    "mark_unique",
    "merge_incremental",
    "merge_snapshot",
    "not_yet_quarantined",
    "process_arrivals",
    "product_performance",
    "read_report",
    "refresh",
    "refresh_reports",
    "run_entity_batch",
    "run_entity_batches",
    "sales_lines",
    "soft_delete_missing",
    "standardize",
    "tune",
    "validate",
]

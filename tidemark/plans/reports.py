"""Sales reports over completed orders.

Every report counts distinct orders, so Spark sums its lines per group and order
before they travel: a hot day, customer, product or category is spread over its
orders. An order or product that is hot in a join is split by the adaptive skew join
(see ``tidemark.session``). Dimensions are joined after the sums wherever the
report allows it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import average, line_revenue, money
from tidemark.sources.tables import overwrite
from tidemark.sources.workspace import Workspace


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == "completed")


def sales_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item of a completed order, with its revenue."""
    buyers = completed(orders).select("order_id", "customer_id", "order_date")
    sold = items.select("order_id", "product_id", "quantity", "unit_price")
    return buyers.join(sold, "order_id", "inner").select(
        "order_id",
        "customer_id",
        "order_date",
        "product_id",
        "quantity",
        line_revenue().alias("line_revenue"),
    )


#: What each report is about, and what it calls its items and its money.
GROUPS = {
    "daily_sales": ("order_date", "items_sold", "revenue"),
    "product_performance": ("product_id", "items_sold", "revenue"),
    "category_performance": ("category", "items_sold", "revenue"),
    "customer_metrics": ("customer_id", "items_bought", "total_spent"),
}


def _totals(items_name: str, revenue_name: str) -> list:
    return [
        F.countDistinct("order_id").alias("order_count"),
        F.sum("quantity").alias(items_name),
        F.sum("line_revenue").alias(revenue_name),
    ]


def _totals_of(name: str, lines: DataFrame) -> DataFrame:
    group, items_name, revenue_name = GROUPS[name]
    dates = [F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")]
    return lines.groupBy(group).agg(*_totals(items_name, revenue_name), *(dates if name == "customer_metrics" else []))


def day_report(days: DataFrame) -> DataFrame:
    """Totals per day as the report shows them."""
    revenue = money(F.col("revenue"))
    return days.withColumn("revenue", revenue).withColumn(
        "average_order_value", average(F.col("revenue"), F.col("order_count"))
    )


def product_report(sold: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per product_id as the report shows them, for known products."""
    named = sold.join(products.select("product_id", "name", "category"), "product_id", "inner")
    # One row per product already, unless the dimension repeats a product.
    report = named.groupBy("product_id", "name", "category").agg(
        F.max("order_count").alias("order_count"),
        F.sum("items_sold").alias("items_sold"),
        F.sum("revenue").cast("decimal(31,2)").alias("revenue"),
    )
    per_item = F.round(F.try_divide("revenue", "items_sold"), 2)
    return report.withColumn("average_selling_price", per_item)


def category_report(sold: DataFrame) -> DataFrame:
    """Totals per category as the report shows them."""
    return sold.withColumn("revenue", money(F.col("revenue"))).withColumn(
        "average_selling_price", average(F.col("revenue"), F.col("items_sold"))
    )


def customer_report(spent: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals per customer_id as the report shows them; unknown customers have no name."""
    spent = spent.withColumn("total_spent", money(F.col("total_spent"))).withColumn(
        "average_order_value", average(F.col("total_spent"), F.col("order_count"))
    )
    names = customers.select("customer_id", "first_name", "last_name", "country")
    return spent.join(names, "customer_id", "left")


def _daily(lines: DataFrame) -> DataFrame:
    return day_report(_totals_of("daily_sales", lines))


def _by_product(lines: DataFrame, products: DataFrame) -> DataFrame:
    return product_report(_totals_of("product_performance", lines), products)


def _by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    labelled = lines.join(products.select("product_id", "category"), "product_id", "inner")
    return category_report(_totals_of("category_performance", labelled))


def _by_customer(lines: DataFrame, customers: DataFrame) -> DataFrame:
    return customer_report(_totals_of("customer_metrics", lines), customers)


def daily_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, items, revenue and average order value per day."""
    return _daily(sales_lines(orders, items))


def product_performance(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, items, revenue and average selling price per known product."""
    return _by_product(sales_lines(orders, items), products)


def category_performance(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, items, revenue and average selling price per category."""
    return _by_category(sales_lines(orders, items), products)


def customer_metrics(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, spending and first / last order per customer; unknown ones have no name."""
    return _by_customer(sales_lines(orders, items), customers)


def build_reports(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    paths: Mapping[str, str],
) -> None:
    """Write the four reports to ``paths`` (report name -> path).

    Orders and items are joined once; their lines are a written table in the
    shared folder, which survives lost executors and goes when all are written.
    """
    with Workspace(orders.sparkSession, "sales-lines") as work:
        lines, _ = work.store(sales_lines(orders, items), "lines")
        reports = {
            "daily_sales": _daily(lines),
            "product_performance": _by_product(lines, products),
            "category_performance": _by_category(lines, products),
            "customer_metrics": _by_customer(lines, customers),
        }
        for name, report in reports.items():
            overwrite(report, paths[name])

"""The given tables as shop data: clean typed rows, and raw text rows with faults.

Column expressions are plain SQL that Spark and DuckDB read alike, so both sides
of a comparison start from the same rows. Faults are spread by key; no row of a
table is left out unless a feed describes a smaller snapshot (``where``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Feed:
    table: str
    columns: dict[str, str]
    where: str = "TRUE"
    copies: str = "1"  # how often each row occurs

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = spark.read.parquet(f"{sf_dir}/{self.table}.parquet").where(self.where)
        if self.copies != "1":
            rows = rows.selectExpr("*", f"explode(sequence(1, {self.copies})) AS copy_number")
        return rows.selectExpr(*[f"{text} AS {name}" for name, text in self.columns.items()])

    def sql(self) -> str:
        selected = ", ".join(f"{text} AS {name}" for name, text in self.columns.items())
        rows = f"SELECT * FROM {self.table} WHERE {self.where}"
        if self.copies != "1":
            rows = (
                f"SELECT *, unnest(generate_series(1, {self.copies})) AS copy_number FROM ({rows})"
            )
        return f"SELECT {selected} FROM ({rows})"

    def but(self, where: str | None = None, copies: str | None = None, **columns: str) -> Feed:
        return replace(
            self,
            columns={**self.columns, **columns},
            where=where or self.where,
            copies=copies or self.copies,
        )


def faulty(key: str, faults: dict[tuple[int, int], str], good: str) -> str:
    """``good``, except where ``key`` leaves a listed remainder."""
    cases = " ".join(
        f"WHEN {key} % {divisor} = {rest} THEN {text}" for (divisor, rest), text in faults.items()
    )
    return f"CASE {cases} ELSE {good} END"


def text(expression: str) -> str:
    return f"CAST({expression} AS string)"


# --- clean, typed -----------------------------------------------------------

STATUS = (
    "CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'F' THEN 'completed' ELSE "
    "CASE WHEN o_orderstatus IS NOT DISTINCT FROM 'O' THEN 'pending' ELSE 'cancelled' END END"
)
ORDERS = Feed(
    "orders",
    {
        "order_id": "o_orderkey",
        "customer_id": "o_custkey",
        "order_date": "CAST(o_orderdate AS date)",
        "status": STATUS,
    },
)

# Price per unit in whole cents, rounded half up without decimal division.
UNIT_CENTS = "floor((2 * floor(l_extendedprice * 100 + 0.5) + l_quantity) / (2 * l_quantity))"
UNIT_PRICE = f"CAST(CAST({UNIT_CENTS} AS decimal(18,0)) * CAST(0.01 AS decimal(3,2)) AS decimal(10,2))"
ITEM_ID = "(l_orderkey * 10 + l_linenumber)"
ITEMS = Feed(
    "lineitem",
    {
        "order_item_id": ITEM_ID,
        "order_id": "l_orderkey",
        "product_id": "l_partkey",
        "quantity": "CAST(l_quantity AS int)",
        "unit_price": UNIT_PRICE,
    },
)
PRICE = "CAST(p_retailprice AS decimal(10,2))"
PRODUCTS = Feed(
    "part",
    {
        "product_id": "p_partkey",
        "name": "p_name",
        "category": "p_type",
        "price": PRICE,
        "stock_quantity": "p_size",
    },
)
# A product list that names some products twice, alike or under two names.
REPEATED_PRODUCTS = PRODUCTS.but(
    name=(
        "CASE WHEN p_size < 10 THEN p_name ELSE p_name || ' ' || CAST(copy_number AS string) END"
    ),
    copies="CASE WHEN p_size < 20 THEN 2 ELSE 1 END",
)
REGISTERED = "DATE '2015-01-01' + CAST(c_custkey % 3650 AS int)"
CUSTOMERS = Feed(
    "customer",
    {
        "customer_id": "c_custkey",
        "first_name": "substr(c_name, 1, 8)",
        "last_name": "substr(c_name, 10)",
        "email": f"'customer' || {text('c_custkey')} || '@example.com'",
        "country": "c_mktsegment",
        "registration_date": REGISTERED,
    },
)

# --- raw text with faults ---------------------------------------------------

RAW_PRODUCTS = Feed(
    "part",
    {
        "product_id": faulty(
            "p_partkey",
            {(41, 7): "NULL", (37, 5): "'n/a'", (89, 3): f"'-' || {text('p_partkey')}"},
            f"' ' || {text('p_partkey')} || ' '",
        ),
        "name": faulty("p_partkey", {(17, 3): "'   '", (19, 4): "NULL"}, "'  ' || p_name || ' '"),
        "category": faulty("p_partkey", {(23, 6): "' '", (29, 8): "NULL"}, "p_type || '  '"),
        "price": faulty(
            "p_partkey",
            {
                (13, 1): f"'-' || {text(PRICE)}",
                (31, 2): "'free'",
                (47, 9): "'19.995'",
                (71, 10): "'123456789012.00'",
                (73, 11): "NULL",
                (79, 12): "'0'",
            },
            text(PRICE),
        ),
        "stock_quantity": faulty(
            "p_partkey",
            {(53, 10): "'-3'", (59, 20): "'7.9'", (67, 30): "'99999999999'"},
            text("p_size"),
        ),
    },
    copies="CASE WHEN p_partkey % 61 = 12 THEN 2 ELSE 1 END",
)
RAW_CUSTOMERS = Feed(
    "customer",
    {
        "customer_id": faulty(
            "c_custkey", {(41, 7): "NULL", (37, 5): "'7.9'"}, text("c_custkey")
        ),
        "first_name": faulty(
            "c_custkey", {(29, 3): "'   '", (31, 4): "NULL"}, "'  ' || substr(c_name, 1, 8)"
        ),
        "last_name": faulty(
            "c_custkey", {(43, 3): "' '", (47, 4): "NULL"}, "substr(c_name, 10) || ' '"
        ),
        "email": faulty(
            "c_custkey",
            {
                (11, 3): "'no-at-sign'",
                (13, 4): "' '",
                (17, 5): "NULL",
                (19, 6): "'a b@example.com'",
                (23, 7): "'name@host'",
            },
            f"' customer' || {text('c_custkey')} || '@example.com '",
        ),
        "country": faulty("c_custkey", {(53, 3): "'  '", (59, 4): "NULL"}, "c_mktsegment"),
        "registration_date": faulty(
            "c_custkey",
            {(61, 3): "'05/01/2026'", (67, 4): "NULL", (71, 6): "'2026-1-5'"},
            text(REGISTERED),
        ),
    },
    copies="CASE WHEN c_custkey % 73 = 12 THEN 3 ELSE 1 END",
)
RAW_ORDERS = Feed(
    "orders",
    {
        "order_id": faulty(
            "o_orderkey",
            {(41, 7): "NULL", (97, 11): f"'A-' || {text('o_orderkey')}"},
            f"' ' || {text('o_orderkey')} || ' '",
        ),
        "customer_id": faulty(
            "o_orderkey", {(31, 4): "NULL", (37, 6): "'0'", (43, 9): "'7.9'"}, text("o_custkey")
        ),
        "order_date": faulty(
            "o_orderkey",
            {(59, 2): "'not-a-date'", (61, 5): "NULL", (67, 1): "'2026-1-5'"},
            text("CAST(o_orderdate AS date)"),
        ),
        "status": faulty(
            "o_orderkey",
            {(13, 1): "'shipped'", (17, 3): "'  '", (47, 8): "NULL", (53, 10): "'Completed'"},
            f"' ' || {STATUS} || ' '",
        ),
    },
    copies="CASE WHEN o_orderkey % 71 = 12 THEN 2 ELSE 1 END",
)
# Line items repeat their (order, line) numbers by nature, so ids repeat too.
RAW_ITEMS = Feed(
    "lineitem",
    {
        "order_item_id": faulty(ITEM_ID, {(101, 7): "NULL", (103, 5): "'x'", (107, 3): f"'-' || {text(ITEM_ID)}"}, text(ITEM_ID)),
        "order_id": faulty(ITEM_ID, {(59, 7): "NULL", (67, 9): "'0'"}, text("l_orderkey")),
        "product_id": faulty(ITEM_ID, {(61, 7): "NULL", (71, 9): "'-1'"}, text("l_partkey")),
        "quantity": faulty(
            ITEM_ID,
            {(13, 1): "'0'", (17, 2): "'-4'", (19, 3): "NULL", (23, 4): "'2.5'"},
            text("CAST(l_quantity AS int)"),
        ),
        "unit_price": faulty(
            ITEM_ID,
            {
                (29, 5): "'-1.00'",
                (31, 6): "'free'",
                (37, 7): "'19.995'",
                (41, 8): "'123456789012.00'",
                (43, 9): "NULL",
                (47, 10): "'0'",
            },
            text(UNIT_PRICE),
        ),
    },
)
RAW = {
    "products": RAW_PRODUCTS,
    "customers": RAW_CUSTOMERS,
    "orders": RAW_ORDERS,
    "order_items": RAW_ITEMS,
}

# Two deliveries of every entity. Snapshots lose and gain rows from one to the
# next; orders and items overlap by a year, with later statuses and amounts.
RAW_FIRST = {
    "products": RAW_PRODUCTS.but(where="p_size <= 40"),
    "customers": RAW_CUSTOMERS.but(where="c_mktsegment <> 'BUILDING'"),
    "orders": RAW_ORDERS.but(where="o_orderdate < DATE '2000-01-01'"),
    "order_items": RAW_ITEMS.but(where="l_shipdate < DATE '2000-01-01'"),
}
RAW_SECOND = {
    "products": RAW_PRODUCTS.but(
        where="p_size >= 8",
        stock_quantity=text("p_size + CASE WHEN p_brand = 'Brand#7' THEN 1 ELSE 0 END"),
    ),
    "customers": RAW_CUSTOMERS.but(
        where="c_mktsegment <> 'MACHINERY'",
        country="CASE WHEN c_nationkey = 3 THEN 'MOVED' ELSE c_mktsegment END",
    ),
    "orders": RAW_ORDERS.but(
        where="o_orderdate >= DATE '1999-01-01'",
        status="CASE WHEN o_orderpriority = '1-URGENT' THEN 'completed' ELSE " + STATUS + " END",
    ),
    "order_items": RAW_ITEMS.but(where="l_shipdate >= DATE '1999-01-01'"),
}

# --- silver states before a load, and typed deliveries ----------------------

PRODUCTS_BEFORE = PRODUCTS.but(
    where="p_size <= 40",
    product_id="CAST(p_partkey AS int)",
    batch_id="'first'",
    is_active="p_retailprice < 980",
)
PRODUCTS_NEXT = PRODUCTS.but(
    where="p_size >= 8",
    product_id="CAST(p_partkey AS int)",
    price=f"CAST({PRICE} + CASE WHEN p_brand = 'Brand#7' THEN 1 ELSE 0 END AS decimal(10,2))",
    batch_id="'second'",
    is_active="TRUE",
)
# Everything the snapshot lists, rejected rows (sizes 5 to 7) and copies included.
PRODUCTS_LISTED = Feed(
    "part",
    {"product_id": "CAST(p_partkey AS int)"},
    where="p_size >= 5",
    copies="CASE WHEN p_size < 8 THEN 3 ELSE 1 END",
)
CUSTOMERS_BEFORE = CUSTOMERS.but(
    where="c_mktsegment <> 'BUILDING'",
    customer_id="CAST(c_custkey AS int)",
    email="CASE WHEN c_nationkey = 5 THEN NULL ELSE lower(c_name) || '@example.com' END",
    batch_id="'first'",
    is_active="c_acctbal > 0",
)
CUSTOMERS_NEXT = CUSTOMERS_BEFORE.but(
    where="c_mktsegment <> 'MACHINERY'",
    country="CASE WHEN c_nationkey = 3 THEN 'MOVED' ELSE c_mktsegment END",
    batch_id="'second'",
    is_active="TRUE",
)
ORDERS_BEFORE = ORDERS.but(
    where="o_orderdate < DATE '2000-01-01'",
    order_id="CAST(o_orderkey AS int)",
    customer_id="CAST(o_custkey AS int)",
    status="CASE WHEN o_orderdate >= DATE '1999-06-01' THEN 'pending' ELSE " + STATUS + " END",
    batch_id="'first'",
)
ORDERS_NEXT = ORDERS.but(
    where="o_orderdate >= DATE '1999-01-01'",
    order_id="CAST(o_orderkey AS int)",
    customer_id="CAST(o_custkey AS int)",
    batch_id="'second'",
)
ITEMS_BEFORE = ITEMS.but(
    where="l_shipdate < DATE '2000-01-01'",
    order_item_id=f"CAST({ITEM_ID} AS int)",
    batch_id="'first'",
)
ITEMS_NEXT = ITEMS_BEFORE.but(where="l_shipdate >= DATE '1999-01-01'", batch_id="'second'")

# File events: content hash, state and time out of the event stream.
FILE_EVENTS = Feed(
    "events",
    {
        "entity": "CASE WHEN user_id % 2 = 0 THEN 'orders' ELSE 'order_items' END",
        "source_file": "'file-' || CAST(user_id AS string) || '.csv'",
        "file_hash": "'hash-' || CAST(user_id AS string)",
        "batch_id": "'batch-' || CAST(event_id AS string)",
        "status": (
            "CASE WHEN event_type = 'purchase' THEN 'SUCCESS' "
            "WHEN event_type = 'error' THEN 'FAILED' ELSE 'BRONZE_WRITTEN' END"
        ),
        "processed_at": "CAST(ts AS timestamp)",
    },
)
# One arriving file per customer: those with events are known, the others new.
ARRIVED_FILES = Feed(
    "customer",
    {
        "entity": "CASE WHEN c_custkey % 2 = 0 THEN 'orders' ELSE 'order_items' END",
        "source_file": "'renamed-' || CAST(c_custkey AS string) || '.csv'",
        "file_hash": "'hash-' || CAST(c_custkey AS string)",
    },
)

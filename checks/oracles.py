"""SQL of every query, written for DuckDB and independent of the library."""

from __future__ import annotations

from checks import feeds

# --- typing -----------------------------------------------------------------


def as_int(column: str) -> str:
    """Text to int; only plain integers count (a cast alone would round '7.9')."""
    return (
        f"CASE WHEN regexp_matches({column}, '^\\s*[+-]?[0-9]+\\s*$') "
        f"THEN TRY_CAST(trim({column}) AS INTEGER) END"
    )


TYPED = {
    "products": f"""
        {as_int("product_id")} AS product_id, trim(name) AS name, trim(category) AS category,
        TRY_CAST(price AS DECIMAL(10,2)) AS price, {as_int("stock_quantity")} AS stock_quantity,
        TRUE AS is_active""",
    "customers": f"""
        {as_int("customer_id")} AS customer_id, trim(first_name) AS first_name,
        trim(last_name) AS last_name, trim(email) AS email, trim(country) AS country,
        TRY_CAST(registration_date AS DATE) AS registration_date, TRUE AS is_active""",
    "orders": f"""
        {as_int("order_id")} AS order_id, {as_int("customer_id")} AS customer_id,
        TRY_CAST(order_date AS DATE) AS order_date, trim(status) AS status""",
    "order_items": f"""
        {as_int("order_item_id")} AS order_item_id, {as_int("order_id")} AS order_id,
        {as_int("product_id")} AS product_id, {as_int("quantity")} AS quantity,
        TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price""",
}
KEYS = {
    "products": "product_id",
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_item_id",
}
COLUMNS = {
    "products": "product_id, name, category, price, stock_quantity, is_active",
    "customers": "customer_id, first_name, last_name, email, country, registration_date, is_active",
    "orders": "order_id, customer_id, order_date, status",
    "order_items": "order_item_id, order_id, product_id, quantity, unit_price",
}
COMPARED = {
    "products": ("name", "category", "price", "stock_quantity", "is_active"),
    "customers": (
        "first_name",
        "last_name",
        "email",
        "country",
        "registration_date",
        "is_active",
    ),
    "orders": ("customer_id", "order_date", "status"),
    "order_items": ("order_id", "product_id", "quantity", "unit_price"),
}


def typed(entity: str, raw_sql: str) -> str:
    return f"SELECT {TYPED[entity]} FROM ({raw_sql})"


# --- rules ------------------------------------------------------------------

RULES = {
    "products": """
        CASE WHEN NOT is_unique THEN 'product_id is not unique' END,
        CASE WHEN product_id IS NULL THEN 'product_id is NULL' END,
        CASE WHEN product_id <= 0 THEN 'product_id <= 0' END,
        CASE WHEN name = '' THEN 'name is empty' END,
        CASE WHEN name IS NULL THEN 'name is NULL' END,
        CASE WHEN category = '' THEN 'category is empty' END,
        CASE WHEN category IS NULL THEN 'category is NULL' END,
        CASE WHEN price < 0 THEN 'price < 0' END,
        CASE WHEN price IS NULL THEN 'price is NULL' END,
        CASE WHEN stock_quantity < 0 THEN 'stock_quantity < 0' END,
        CASE WHEN stock_quantity IS NULL THEN 'stock_quantity is NULL' END""",
    "customers": r"""
        CASE WHEN NOT is_unique THEN 'customer_id is not unique' END,
        CASE WHEN customer_id IS NULL THEN 'customer_id is NULL' END,
        CASE WHEN customer_id <= 0 THEN 'customer_id <= 0' END,
        CASE WHEN first_name = '' THEN 'first_name is empty' END,
        CASE WHEN first_name IS NULL THEN 'first_name is NULL' END,
        CASE WHEN last_name = '' THEN 'last_name is empty' END,
        CASE WHEN last_name IS NULL THEN 'last_name is NULL' END,
        CASE WHEN country = '' THEN 'country is empty' END,
        CASE WHEN country IS NULL THEN 'country is NULL' END,
        CASE WHEN email = '' THEN 'email is empty' END,
        CASE WHEN email IS NULL THEN 'email is NULL' END,
        CASE WHEN NOT regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')
             THEN 'email format is invalid' END,
        CASE WHEN registration_date IS NULL THEN 'registration_date is NULL' END""",
    "orders": """
        CASE WHEN NOT is_unique THEN 'order_id is not unique' END,
        CASE WHEN order_id IS NULL THEN 'order_id is NULL' END,
        CASE WHEN order_id <= 0 THEN 'order_id <= 0' END,
        CASE WHEN customer_id IS NULL THEN 'customer_id is NULL' END,
        CASE WHEN customer_id <= 0 THEN 'customer_id <= 0' END,
        CASE WHEN order_date IS NULL THEN 'order_date is NULL' END,
        CASE WHEN status = '' THEN 'status is empty' END,
        CASE WHEN status IS NULL THEN 'status is NULL' END,
        CASE WHEN status NOT IN ('pending', 'completed', 'cancelled')
             THEN 'status is invalid' END""",
    "order_items": """
        CASE WHEN NOT is_unique THEN 'order_item_id is not unique' END,
        CASE WHEN order_item_id IS NULL THEN 'order_item_id is NULL' END,
        CASE WHEN order_item_id <= 0 THEN 'order_item_id <= 0' END,
        CASE WHEN order_id IS NULL THEN 'order_id is NULL' END,
        CASE WHEN order_id <= 0 THEN 'order_id <= 0' END,
        CASE WHEN product_id IS NULL THEN 'product_id is NULL' END,
        CASE WHEN product_id <= 0 THEN 'product_id <= 0' END,
        CASE WHEN quantity IS NULL THEN 'quantity is NULL' END,
        CASE WHEN quantity <= 0 THEN 'quantity <= 0' END,
        CASE WHEN unit_price IS NULL THEN 'unit_price is NULL' END,
        CASE WHEN unit_price < 0 THEN 'unit_price < 0' END""",
}


def validated(entity: str, typed_sql: str) -> str:
    key = KEYS[entity]
    return f"""
        SELECT *, errors = '' AS is_valid FROM (
            SELECT *, concat_ws('; ', {RULES[entity]}) AS errors FROM (
                SELECT *, {key} IS NULL OR count(*) OVER (PARTITION BY {key}) = 1 AS is_unique
                FROM ({typed_sql})))"""


def validated_raw(entity: str, feed: feeds.Feed) -> str:
    return validated(entity, typed(entity, feed.sql()))


def split(sql: str, valid: bool, columns: str = "*") -> str:
    return f"SELECT {columns} FROM ({sql}) WHERE {'' if valid else 'NOT '}is_valid"


# --- merges -----------------------------------------------------------------


def merged(entity: str, target: str, source: str, columns: str, ids: str | None = None, label: bool = False) -> str:
    """Next state of a keyed table; with ``ids`` also the soft delete; with ``label`` what happened to each row."""
    key = KEYS[entity]
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in COMPARED[entity])
    take = f"s.{key} IS NOT NULL AND (t.{key} IS NULL OR {changed})"
    parts = []
    for column in [c.strip() for c in columns.split(",")]:
        value = f"CASE WHEN {take} THEN s.{column} ELSE t.{column} END"
        if ids is not None and column == "is_active":
            value = (
                f"CASE WHEN s.{key} IS NULL AND t.{key} NOT IN "
                f"(SELECT {key} FROM ({ids}) WHERE {key} IS NOT NULL) THEN FALSE ELSE {value} END"
            )
        parts.append(f"{value} AS {column}")
    if label:
        flips = ""
        if ids is not None:
            flips = f"""
                WHEN s.{key} IS NULL AND t.is_active
                     AND t.{key} NOT IN (SELECT {key} FROM ({ids}) WHERE {key} IS NOT NULL) THEN 'deactivated'
                WHEN s.{key} IS NOT NULL AND NOT t.is_active THEN 'reactivated'"""
        parts.append(
            f"CASE WHEN t.{key} IS NULL THEN 'inserted' {flips} WHEN {take} THEN 'updated' ELSE 'same' END AS change"
        )
    return f"""
        SELECT {", ".join(parts)}
        FROM ({target}) t FULL OUTER JOIN ({source}) s ON t.{key} = s.{key}"""


def delivered_twice(entity: str, label: bool = False) -> str:
    """Silver after both raw deliveries, with the delivery a row came from."""
    columns = f"{COLUMNS[entity]}, delivery"
    deliveries = []
    for name, raw in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND)):
        checked = validated_raw(entity, raw[entity])
        deliveries.append(
            f"SELECT {COLUMNS[entity]}, '{name}' AS delivery FROM ({checked}) WHERE is_valid"
        )
    ids = None
    if "is_active" in columns:
        ids = typed(entity, feeds.RAW_SECOND[entity].sql())
    return merged(entity, deliveries[0], deliveries[1], columns, ids, label)


def change_counts() -> str:
    """How many rows of silver each delivery changed, by kind."""
    kinds = ("inserted", "updated", "deactivated", "reactivated", "same")
    parts = []
    for entity in feeds.RAW:
        first = validated_raw(entity, feeds.RAW_FIRST[entity])
        zeros = ", ".join(f"CAST(0 AS BIGINT) AS {kind}" for kind in kinds[1:])
        parts.append(
            f"SELECT '{entity}' AS entity, 'first' AS delivery, count(*) AS inserted, {zeros} FROM ({first}) WHERE is_valid"
        )
        counted = ", ".join(f"count(*) FILTER (change = '{kind}') AS {kind}" for kind in kinds)
        parts.append(f"SELECT '{entity}' AS entity, 'second' AS delivery, {counted} FROM ({delivered_twice(entity, True)})")
    return " UNION ALL ".join(parts)


# --- reports ----------------------------------------------------------------

CENT = "CAST(0.01 AS DECIMAL(3,2))"


def from_cents(cents: str, kind: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * {CENT} AS {kind})"


def mean(cents: str, count: str, kind: str) -> str:
    """Non-negative cents per unit, rounded half up in whole numbers."""
    return from_cents(f"(2 * {cents} + {count}) // (2 * {count})", kind)


def lines(orders: str, items: str) -> str:
    return f"""
        SELECT o.order_id, o.customer_id, o.order_date, i.product_id, i.quantity,
               CAST(i.quantity AS BIGINT) * CAST(i.unit_price * 100 AS BIGINT) AS cents
        FROM ({orders}) o JOIN ({items}) i ON o.order_id = i.order_id
        WHERE o.status = 'completed'"""


TOTALS = """
    count(DISTINCT order_id) AS order_count,
    CAST(sum(quantity) AS BIGINT) AS items,
    CAST(sum(cents) AS BIGINT) AS cents"""


def daily_sales(orders: str, items: str) -> str:
    return f"""
        SELECT order_date, order_count, items AS items_sold,
               {from_cents("cents", "DECIMAL(18,2)")} AS revenue,
               {mean("cents", "order_count", "DECIMAL(18,2)")} AS average_order_value
        FROM (SELECT order_date, {TOTALS} FROM ({lines(orders, items)}) GROUP BY order_date)"""


def product_performance(orders: str, items: str, products: str) -> str:
    return f"""
        SELECT product_id, name, category, order_count, items AS items_sold,
               {from_cents("cents", "DECIMAL(31,2)")} AS revenue,
               {mean("cents", "items", "DECIMAL(32,2)")} AS average_selling_price
        FROM (SELECT l.product_id, p.name, p.category, {TOTALS}
              FROM ({lines(orders, items)}) l JOIN ({products}) p ON l.product_id = p.product_id
              GROUP BY ALL)"""


def category_performance(orders: str, items: str, products: str) -> str:
    return f"""
        SELECT category, order_count, items AS items_sold,
               {from_cents("cents", "DECIMAL(18,2)")} AS revenue,
               {mean("cents", "items", "DECIMAL(18,2)")} AS average_selling_price
        FROM (SELECT p.category, {TOTALS}
              FROM ({lines(orders, items)}) l JOIN ({products}) p ON l.product_id = p.product_id
              GROUP BY ALL)"""


def customer_metrics(orders: str, items: str, customers: str) -> str:
    return f"""
        SELECT m.customer_id, order_count, items AS items_bought,
               {from_cents("cents", "DECIMAL(18,2)")} AS total_spent,
               first_order_date, last_order_date,
               {mean("cents", "order_count", "DECIMAL(18,2)")} AS average_order_value,
               c.first_name, c.last_name, c.country
        FROM (SELECT customer_id, {TOTALS}, min(order_date) AS first_order_date,
                     max(order_date) AS last_order_date
              FROM ({lines(orders, items)}) GROUP BY customer_id) m
        LEFT JOIN ({customers}) c ON m.customer_id = c.customer_id"""


# --- the queries ------------------------------------------------------------


def all_queries() -> dict[str, str]:
    orders, items = feeds.ORDERS.sql(), feeds.ITEMS.sql()
    products, customers = feeds.PRODUCTS.sql(), feeds.CUSTOMERS.sql()
    sql = {
        "daily_sales": daily_sales(orders, items),
        "product_performance": product_performance(orders, items, products),
        "category_performance": category_performance(orders, items, products),
        "customer_metrics": customer_metrics(orders, items, customers),
        "sales_lines": f"""
            SELECT order_id, customer_id, order_date, product_id, quantity,
                   CAST(CAST(cents AS DECIMAL(18,0)) * {CENT} AS DECIMAL(21,2)) AS line_revenue
            FROM ({lines(orders, items)})""",
        "daily_sales_orders_without_items": daily_sales(
            orders, feeds.ITEMS.but(where="l_returnflag = 'N'").sql()
        ),
        "product_performance_unknown_products": product_performance(
            orders, items, feeds.PRODUCTS.but(where="p_size <= 25").sql()
        ),
        "category_performance_unknown_products": category_performance(
            orders, items, feeds.PRODUCTS.but(where="p_size <= 25").sql()
        ),
        "customer_metrics_unknown_customers": customer_metrics(
            orders, items, feeds.CUSTOMERS.but(where="c_acctbal > 0").sql()
        ),
        "product_performance_repeated_products": product_performance(
            orders,
            items,
            feeds.REPEATED_PRODUCTS.sql(),
        ),
        "unique_item_ids": f"""
            SELECT order_item_id, quantity, unit_price,
                   count(*) OVER (PARTITION BY order_item_id) = 1 AS is_unique FROM ({items})""",
        "repeated_item_ids": f"""
            SELECT order_item_id, count(*) AS copies FROM ({items})
            GROUP BY order_item_id HAVING count(*) > 1""",
        "unique_customer_of_order": f"""
            SELECT order_id, customer_id,
                   customer_id IS NULL OR count(*) OVER (PARTITION BY customer_id) = 1 AS is_unique
            FROM ({typed("orders", feeds.RAW_ORDERS.sql())})""",
    }

    counts, errors = [], []
    for entity, feed in feeds.RAW.items():
        sql[f"standardize_{entity}"] = typed(entity, feed.sql())
        checked = validated_raw(entity, feed)
        shown = f"{COLUMNS[entity]}, is_unique, errors, is_valid"
        sql[f"validate_{entity}"] = f"SELECT {shown} FROM ({checked})"
        sql[f"valid_{entity}"] = split(checked, True, COLUMNS[entity])
        sql[f"invalid_{entity}"] = split(checked, False, f"{COLUMNS[entity]}, errors")
        counts.append(
            f"""SELECT '{entity}' AS entity, count(*) AS total_rows,
                count(*) FILTER (is_valid) AS valid_rows,
                count(*) FILTER (NOT is_valid) AS invalid_rows FROM ({checked})"""
        )
        errors.append(
            f"""SELECT '{entity}' AS entity, error, count(*) AS row_count FROM (
                SELECT unnest(string_split(errors, '; ')) AS error
                FROM ({checked}) WHERE errors <> '') GROUP BY error"""
        )
    sql["batch_counts"] = " UNION ALL ".join(counts)
    sql["error_counts"] = " UNION ALL ".join(errors)

    listed = feeds.PRODUCTS_LISTED.sql()
    products_before, products_next = feeds.PRODUCTS_BEFORE.sql(), feeds.PRODUCTS_NEXT.sql()
    customers_before, customers_next = feeds.CUSTOMERS_BEFORE.sql(), feeds.CUSTOMERS_NEXT.sql()
    orders_before, orders_next = feeds.ORDERS_BEFORE.sql(), feeds.ORDERS_NEXT.sql()
    product_columns = f"{COLUMNS['products']}, batch_id"
    customer_columns = f"{COLUMNS['customers']}, batch_id"
    order_columns = f"{COLUMNS['orders']}, batch_id"
    item_columns = f"{COLUMNS['order_items']}, batch_id"
    items_before = split(validated("order_items", feeds.ITEMS_BEFORE.sql()), True, item_columns)
    items_next = split(validated("order_items", feeds.ITEMS_NEXT.sql()), True, item_columns)
    snapshot = merged("products", products_before, products_next, product_columns, listed)
    upsert = merged("orders", orders_before, orders_next, order_columns)
    sql |= {
        "merge_changes_products": merged("products", products_before, products_next, product_columns, listed, True),
        "merge_changes_customers": merged(
            "customers", customers_before, customers_next, customer_columns, customers_next, True
        ),
        "merge_changes_orders": merged("orders", orders_before, orders_next, order_columns, label=True),
        "merge_snapshot_products": snapshot,
        "merge_snapshot_twice": snapshot,
        "merge_snapshot_customers": merged(
            "customers", customers_before, customers_next, customer_columns, customers_next
        ),
        "merge_snapshot_reactivates": merged(
            "products",
            feeds.PRODUCTS_BEFORE.but(is_active="FALSE").sql(),
            products_next,
            product_columns,
            listed,
        ),
        "merge_snapshot_keeps_rejected": merged(
            "products", products_before, products_next, product_columns, products_before
        ),
        "merge_snapshot_of_nothing": f"""
            SELECT * REPLACE (FALSE AS is_active) FROM ({products_before})""",
        "merge_incremental_orders": upsert,
        "merge_incremental_orders_small_batch": upsert,
        "merge_incremental_twice": upsert,
        "merge_incremental_order_items": merged(
            "order_items", items_before, items_next, item_columns
        ),
        "merge_incremental_first_load": f"SELECT {order_columns} FROM ({orders_next})",
        "soft_delete_missing": f"""
            SELECT * REPLACE (is_active AND product_id IN (SELECT product_id FROM ({listed}))
                              AS is_active) FROM ({products_before})""",
        "missing_products": f"""
            SELECT product_id FROM ({products_before})
            WHERE product_id NOT IN (SELECT product_id FROM ({listed}))""",
    }

    rejected = split(validated_raw("orders", feeds.RAW_ORDERS), False)
    stored = split(validated_raw("orders", feeds.RAW_FIRST["orders"]), False)
    unseen = f"""
        SELECT order_id, customer_id, order_date, status, errors FROM ({rejected}) r
        WHERE NOT EXISTS (SELECT 1 FROM ({stored}) q WHERE """
    sql |= {
        "quarantine_new_rows": f"{unseen} q.order_id IS NOT DISTINCT FROM r.order_id)",
        "quarantine_plain_equality": f"{unseen} q.order_id = r.order_id)",
        "quarantine_other_batch": f"""
            SELECT order_id, customer_id, order_date, status, errors FROM ({rejected})""",
    }

    events, arrived = feeds.FILE_EVENTS.sql(), feeds.ARRIVED_FILES.sql()
    latest = f"""
        SELECT entity, file_hash, source_file, batch_id, status FROM ({events})
        QUALIFY row_number() OVER (
            PARTITION BY entity, file_hash ORDER BY processed_at DESC, status DESC) = 1"""
    sql |= {
        "latest_file_states": latest,
        "files_to_process": f"""
            SELECT f.entity, f.source_file, f.file_hash, e.batch_id, e.status,
                   CASE WHEN e.status IS NULL THEN 'run' WHEN e.status = 'BRONZE_WRITTEN'
                        THEN 'resume' WHEN e.status = 'SUCCESS' THEN 'skip' ELSE 'unknown' END
                   AS action
            FROM ({arrived}) f LEFT JOIN ({latest}) e
              ON f.entity = e.entity AND f.file_hash = e.file_hash""",
    }

    for entity, feed in feeds.RAW.items():
        sql[f"csv_{entity}"] = feed.sql()
    sql["bronze_history"] = " UNION ALL ".join(
        f"SELECT *, '{label}' AS batch_id, TRUE AS has_source, TRUE AS has_time "
        f"FROM ({feed['orders'].sql()})"
        for label, feed in (("orders-first", feeds.RAW_FIRST), ("orders-second", feeds.RAW_SECOND))
    )
    rows = f"SELECT customer_id, first_name, last_name, email, country, registration_date FROM ({feeds.RAW['customers'].sql()})"
    renamed = rows.replace("country", "CASE WHEN trim(country) = 'BUILDING' THEN 'OTHER' ELSE country END AS country", 1)
    variants = {
        "one part": rows,
        "two parts": rows,
        "three parts": rows,
        "one country renamed": renamed,
        "every row twice": f"{rows} UNION ALL {rows}",
    }
    sql["content_identity"] = " UNION ALL ".join(
        f"""SELECT '{name}' AS variant, count(*) AS lines,
              NOT EXISTS (({rows}) EXCEPT ALL ({variant}))
              AND NOT EXISTS (({variant}) EXCEPT ALL ({rows})) AS same_content
            FROM ({variant})"""
        for name, variant in variants.items()
    )
    sql["file_bytes"] = """
        SELECT c_nationkey AS nation, strlen(body)::BIGINT AS length, sha256(body) AS sha256
        FROM (SELECT c_nationkey, string_agg(
                c_custkey || ',' || c_name || ',' || c_mktsegment || chr(10), '' ORDER BY c_custkey) AS body
              FROM customer GROUP BY c_nationkey)"""

    silver = {entity: delivered_twice(entity) for entity in KEYS}
    for entity, state in silver.items():
        sql[f"silver_{entity}"] = state
        sql[f"folded_{entity}"] = state
        sql[f"quarantine_{entity}"] = " UNION ALL ".join(
            f"SELECT {COLUMNS[entity]}, errors, '{label}' AS delivery "
            f"FROM ({validated_raw(entity, raw[entity])}) WHERE NOT is_valid"
            for label, raw in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND))
        )
    sql |= {
        "refreshed_daily_sales": daily_sales(silver["orders"], silver["order_items"]),
        "refreshed_product_performance": product_performance(
            silver["orders"], silver["order_items"], silver["products"]
        ),
        "refreshed_category_performance": category_performance(
            silver["orders"], silver["order_items"], silver["products"]
        ),
        "refreshed_customer_metrics": customer_metrics(
            silver["orders"], silver["order_items"], silver["customers"]
        ),
    }
    logged_counts, logged_errors, states = [], [], []
    for entity in KEYS:
        for label, raw in (("first", feeds.RAW_FIRST), ("second", feeds.RAW_SECOND)):
            checked = validated_raw(entity, raw[entity])
            logged_counts.append(
                f"""SELECT '{entity}' AS entity, '{label}' AS delivery, count(*) AS total_rows,
                    count(*) FILTER (is_valid) AS valid_rows,
                    count(*) FILTER (NOT is_valid) AS invalid_rows FROM ({checked})"""
            )
            logged_errors.append(
                f"""SELECT '{entity}' AS entity, '{label}' AS delivery, error,
                    count(*) AS row_count FROM (SELECT unnest(string_split(errors, '; ')) AS error
                    FROM ({checked}) WHERE errors <> '') GROUP BY error"""
            )
            for status in ("BRONZE_WRITTEN", "SUCCESS"):
                states.append(
                    f"SELECT '{entity}' AS entity, '{label}' AS delivery, '{status}' AS status"
                )
    sql["logged_batch_counts"] = " UNION ALL ".join(logged_counts)
    sql["logged_error_counts"] = " UNION ALL ".join(logged_errors)
    sql["logged_file_states"] = " UNION ALL ".join(states)
    sql["logged_change_counts"] = change_counts()
    cut = f"""
        SELECT CAST(order_id AS INTEGER) AS order_id, CAST(customer_id AS INTEGER) AS customer_id,
               CASE WHEN order_id % 50 <> 1 THEN order_date END AS order_date,
               CASE WHEN order_id % 50 <> 1 THEN status END AS status,
               CASE order_id % 50 WHEN 1 THEN order_id || ',' || customer_id
                    WHEN 2 THEN order_id || ',' || customer_id || ',' || order_date || ',' || status || ',more'
               END AS line
        FROM ({orders})"""
    sql["misfit_orders"] = f"""
        SELECT {COLUMNS["orders"]}, line,
               concat_ws('; ', nullif(errors, ''), CASE WHEN line IS NOT NULL THEN 'row does not fit its columns' END) AS errors
        FROM ({validated("orders", cut)})"""
    sql["arriving_orders"] = split(
        validated_raw("orders", feeds.RAW_ORDERS), True, COLUMNS["orders"]
    )
    return sql

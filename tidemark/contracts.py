"""Entity contracts: everything that differs between the four entities, as data."""

from __future__ import annotations

from dataclasses import dataclass, replace

# --- Fixed values -----------------------------------------------------------
# Column names, types, rule messages (in array order), the accepted statuses,
# the email pattern and the compared columns define the results and must not
# be changed. Each rule reads: message -> SQL condition that raises it.

PRODUCT_COLUMNS = {
    "product_id": "int",
    "name": "string",
    "category": "string",
    "price": "decimal(10,2)",
    "stock_quantity": "int",
}
PRODUCT_RULES = {
    "product_id is not unique": "NOT is_unique",
    "product_id is NULL": "product_id IS NULL",
    "product_id <= 0": "product_id <= 0",
    "name is empty": "name = ''",
    "name is NULL": "name IS NULL",
    "category is empty": "category = ''",
    "category is NULL": "category IS NULL",
    "price < 0": "price < 0",
    "price is NULL": "price IS NULL",
    "stock_quantity < 0": "stock_quantity < 0",
    "stock_quantity is NULL": "stock_quantity IS NULL",
}
PRODUCT_COMPARE = ("name", "category", "price", "stock_quantity", "is_active")

CUSTOMER_COLUMNS = {
    "customer_id": "int",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "country": "string",
    "registration_date": "date",
}
CUSTOMER_RULES = {
    "customer_id is not unique": "NOT is_unique",
    "customer_id is NULL": "customer_id IS NULL",
    "customer_id <= 0": "customer_id <= 0",
    "first_name is empty": "first_name = ''",
    "first_name is NULL": "first_name IS NULL",
    "last_name is empty": "last_name = ''",
    "last_name is NULL": "last_name IS NULL",
    "country is empty": "country = ''",
    "country is NULL": "country IS NULL",
    "email is empty": "email = ''",
    "email is NULL": "email IS NULL",
    "email format is invalid": r"NOT email RLIKE r'^[^@\s]+@[^@\s]+\.[^@\s]+$'",
    "registration_date is NULL": "registration_date IS NULL",
}
CUSTOMER_COMPARE = (
    "first_name",
    "last_name",
    "email",
    "country",
    "registration_date",
    "is_active",
)

ORDER_COLUMNS = {
    "order_id": "int",
    "customer_id": "int",
    "order_date": "date",
    "status": "string",
}
ORDER_RULES = {
    "order_id is not unique": "NOT is_unique",
    "order_id is NULL": "order_id IS NULL",
    "order_id <= 0": "order_id <= 0",
    "customer_id is NULL": "customer_id IS NULL",
    "customer_id <= 0": "customer_id <= 0",
    "order_date is NULL": "order_date IS NULL",
    "status is empty": "status = ''",
    "status is NULL": "status IS NULL",
    "status is invalid": "status NOT IN ('pending', 'completed', 'cancelled')",
}
ORDER_COMPARE = ("customer_id", "order_date", "status")

ORDER_ITEM_COLUMNS = {
    "order_item_id": "int",
    "order_id": "int",
    "product_id": "int",
    "quantity": "int",
    "unit_price": "decimal(10,2)",
}
ORDER_ITEM_RULES = {
    "order_item_id is not unique": "NOT is_unique",
    "order_item_id is NULL": "order_item_id IS NULL",
    "order_item_id <= 0": "order_item_id <= 0",
    "order_id is NULL": "order_id IS NULL",
    "order_id <= 0": "order_id <= 0",
    "product_id is NULL": "product_id IS NULL",
    "product_id <= 0": "product_id <= 0",
    "quantity is NULL": "quantity IS NULL",
    "quantity <= 0": "quantity <= 0",
    "unit_price is NULL": "unit_price IS NULL",
    "unit_price < 0": "unit_price < 0",
}
ORDER_ITEM_COMPARE = ("order_id", "product_id", "quantity", "unit_price")
# --- End of fixed values ----------------------------------------------------

LINEAGE = {
    "ingestion_timestamp": "timestamp",
    "source_file": "string",
    "batch_id": "string",
}

#: Holds the whole line of a row that does not fit, if an entity asks for it.
MISFIT = "misfit"


@dataclass(frozen=True, eq=False)
class Entity:
    """One source entity.

    ``columns`` maps source columns, in file order, to their silver types.
    A ``snapshot`` file lists every live row, so rows missing from it are
    soft-deleted; otherwise a file only carries new and changed rows.

    The silver table is cut into key ranges of ``slice_width``: at most 512 of them
    for 32-bit keys, of some 100 to 500 MB each.
    """

    name: str
    key: str
    columns: dict[str, str]
    rules: dict[str, str]
    compare: tuple[str, ...]
    snapshot: bool
    slice_width: int = 4_194_304  # keys per slice of the silver table
    misfits: bool = False  # whether rows of too few or too many values are told apart

    @property
    def raw_columns(self) -> list[str]:
        """What is read of a file: its columns, and the whole line of a row that does not fit them."""
        return [*self.columns, *([MISFIT] if self.misfits else [])]

    @property
    def raw_schema(self) -> str:
        return ", ".join(f"{column} string" for column in self.raw_columns)

    @property
    def bronze_schema(self) -> str:
        lineage = ", ".join(f"{name} {kind}" for name, kind in LINEAGE.items())
        return f"{self.raw_schema}, {lineage}"

    def with_misfits(self) -> Entity:
        """The same entity, but rows of too few or too many values are rejected, instead of filled up or cut."""
        rules = {**self.rules, "row does not fit its columns": f"{MISFIT} IS NOT NULL"}
        return replace(self, rules=rules, misfits=True)

    def with_wide_keys(self, slice_width: int = 2**26) -> Entity:
        """The same entity with 64-bit integers, for keys beyond 2,147,483,647."""
        wide = {name: "bigint" if kind == "int" else kind for name, kind in self.columns.items()}
        return replace(self, columns=wide, slice_width=slice_width)


PRODUCTS = Entity(
    "products", "product_id", PRODUCT_COLUMNS, PRODUCT_RULES, PRODUCT_COMPARE, snapshot=True
)
CUSTOMERS = Entity(
    "customers", "customer_id", CUSTOMER_COLUMNS, CUSTOMER_RULES, CUSTOMER_COMPARE, snapshot=True
)
ORDERS = Entity("orders", "order_id", ORDER_COLUMNS, ORDER_RULES, ORDER_COMPARE, snapshot=False)
ORDER_ITEMS = Entity(
    "order_items",
    "order_item_id",
    ORDER_ITEM_COLUMNS,
    ORDER_ITEM_RULES,
    ORDER_ITEM_COMPARE,
    snapshot=False,
)

# In load order.
ENTITIES = {entity.name: entity for entity in (PRODUCTS, CUSTOMERS, ORDERS, ORDER_ITEMS)}

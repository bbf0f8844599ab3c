"""Source layouts, warehouse tables and their declared constraints, as plain data."""

from __future__ import annotations

from dataclasses import dataclass, field

STAGING_TYPES = {
    "id": "BIGINT",
    "int": "INT",
    "money": "DECIMAL(18,6)",
    "date": "DATE",
    "text": "STRING",
}


@dataclass(frozen=True)
class Source:
    """One extract: its file, typed columns and cleaning rules."""

    name: str
    file: str
    columns: dict[str, str]
    key: str
    required: tuple[str, ...]
    non_negative: tuple[str, ...] = ()

    def staging_type(self, column: str) -> str:
        return STAGING_TYPES[self.columns[column]]


SALES = Source(
    name="sales",
    file="sales.csv",
    columns={
        "order_id": "id",
        "product_id": "id",
        "customer_id": "id",
        "store_id": "id",
        "quantity": "int",
        "price": "money",
        "order_date": "date",
    },
    key="order_id",
    required=("order_id", "product_id", "customer_id", "store_id"),
    non_negative=("quantity", "price"),
)

CUSTOMERS = Source(
    name="customers",
    file="customers.csv",
    columns={
        "customer_id": "id",
        "first_name": "text",
        "last_name": "text",
        "email": "text",
        "phone": "text",
        "city": "text",
        "state": "text",
        "registration_date": "date",
    },
    key="customer_id",
    required=("customer_id", "first_name", "last_name", "email"),
)

PRODUCTS = Source(
    name="products",
    file="products.csv",
    columns={
        "product_id": "id",
        "product_name": "text",
        "category": "text",
        "unit_cost": "money",
        "supplier": "text",
    },
    key="product_id",
    required=("product_id", "product_name", "category"),
    non_negative=("unit_cost",),
)

STORES = Source(
    name="stores",
    file="stores.csv",
    columns={
        "store_id": "id",
        "store_name": "text",
        "city": "text",
        "state": "text",
        "region": "text",
        "manager_name": "text",
        "opening_date": "date",
    },
    key="store_id",
    required=("store_id", "store_name", "city", "region"),
)

SOURCES = {s.name: s for s in (SALES, CUSTOMERS, PRODUCTS, STORES)}


@dataclass(frozen=True)
class Rule:
    """A row constraint. Like a SQL CHECK it is broken only where the test is false."""

    name: str
    test: str


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"not_null:{c}", f"{c} IS NOT NULL") for c in columns]


def max_length(**limits: int) -> list[Rule]:
    return [Rule(f"max_length:{c}", f"char_length({c}) <= {n}") for c, n in limits.items()]


def fits_money(*columns: str) -> list[Rule]:
    return [
        Rule(f"fits_money:{c}", f"{c} IS NULL OR try_cast({c} AS DECIMAL(10,2)) IS NOT NULL")
        for c in columns
    ]


@dataclass(frozen=True)
class Table:
    """One warehouse table: columns in order, keys, partitioning and row rules."""

    name: str
    columns: dict[str, str]
    surrogate_key: str
    natural_key: str | None = None
    partition_by: str | None = None
    rules: list[Rule] = field(default_factory=list)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())


DIM_DATE = Table(
    name="dim_date",
    columns={
        "date_key": "INT",
        "full_date": "DATE",
        "year": "INT",
        "quarter": "INT",
        "month": "INT",
        "month_name": "STRING",
        "day": "INT",
        "day_of_week": "INT",
        "day_name": "STRING",
        "week_of_year": "INT",
        "is_weekend": "BOOLEAN",
        "fiscal_year": "INT",
    },
    surrogate_key="date_key",
    natural_key="full_date",
    rules=[
        *not_null(
            "full_date", "year", "quarter", "month", "month_name", "day",
            "day_of_week", "day_name", "week_of_year", "is_weekend", "fiscal_year",
        ),
        *max_length(month_name=20, day_name=20),
    ],
)

DIM_PRODUCT = Table(
    name="dim_product",
    columns={
        "product_key": "BIGINT",
        "product_id": "BIGINT",
        "product_name": "STRING",
        "category": "STRING",
        "unit_cost": "DECIMAL(10,2)",
        "supplier": "STRING",
        "effective_date": "DATE",
        "is_current": "BOOLEAN",
    },
    surrogate_key="product_key",
    natural_key="product_id",
    rules=[
        *not_null(
            "product_id", "product_name", "category", "unit_cost", "supplier",
            "effective_date", "is_current",
        ),
        *max_length(product_name=255, category=100, supplier=100),
        *fits_money("unit_cost"),
    ],
)

DIM_CUSTOMER = Table(
    name="dim_customer",
    columns={
        "customer_key": "BIGINT",
        "customer_id": "BIGINT",
        "first_name": "STRING",
        "last_name": "STRING",
        "email": "STRING",
        "phone": "STRING",
        "city": "STRING",
        "state": "STRING",
        "registration_date": "DATE",
        "customer_segment": "STRING",
    },
    surrogate_key="customer_key",
    natural_key="customer_id",
    rules=[
        *not_null(
            "customer_id", "first_name", "last_name", "email",
            "city", "state", "registration_date",
        ),
        *max_length(
            first_name=100, last_name=100, email=255, phone=20,
            city=100, state=10, customer_segment=50,
        ),
    ],
)

DIM_STORE = Table(
    name="dim_store",
    columns={
        "store_key": "BIGINT",
        "store_id": "BIGINT",
        "store_name": "STRING",
        "city": "STRING",
        "state": "STRING",
        "region": "STRING",
        "manager_name": "STRING",
        "opening_date": "DATE",
    },
    surrogate_key="store_key",
    natural_key="store_id",
    rules=[
        *not_null("store_id", "store_name", "city", "state", "region", "opening_date"),
        *max_length(store_name=100, city=100, state=10, region=50, manager_name=100),
    ],
)

FACT_SALES = Table(
    name="fact_sales",
    columns={
        "sale_id": "BIGINT",
        "product_key": "BIGINT",
        "customer_key": "BIGINT",
        "store_key": "BIGINT",
        "date_key": "INT",
        "quantity": "INT",
        "unit_price": "DECIMAL(10,2)",
        "revenue": "DECIMAL(10,2)",
        "cost": "DECIMAL(10,2)",
        "profit": "DECIMAL(10,2)",
        "created_at": "TIMESTAMP",
        "date_month": "INT",
    },
    surrogate_key="sale_id",
    partition_by="date_month",
    rules=[
        *not_null(
            "product_key", "customer_key", "store_key", "date_key",
            "quantity", "unit_price", "revenue", "cost", "profit",
        ),
        Rule("check:quantity_positive", "quantity > 0"),
        Rule("check:unit_price_not_negative", "unit_price >= 0"),
        Rule("check:revenue_not_negative", "revenue >= 0"),
        *fits_money("unit_price", "revenue", "cost", "profit"),
    ],
)

# Each fact column that points at a dimension, and the dimension it points at.
FOREIGN_KEYS = {
    "product_key": DIM_PRODUCT,
    "customer_key": DIM_CUSTOMER,
    "store_key": DIM_STORE,
    "date_key": DIM_DATE,
}

TABLES = {t.name: t for t in (DIM_DATE, DIM_PRODUCT, DIM_CUSTOMER, DIM_STORE, FACT_SALES)}

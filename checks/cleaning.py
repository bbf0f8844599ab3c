"""P, Q and U: projections, predicates and deduplication."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import build, numbered, query, star
from sparkmart.functions.dates import segment
from sparkmart.functions.parse import null_if_token
from sparkmart.operators import cleaning
from sparkmart.plans import reports, transforms
from sparkmart.schemas import Source
from sparkmart.sources import driver_tables
from sparkmart.sources.driver_tables import AS_OF, table
from sparkmart.sources.extracts import frame_extract
from sparkmart.staging import Staging

MEASURE = "DECIMAL(28,6)"


def cleaned(spark, sf_dir, name):
    return build(spark, sf_dir).cleaned[name].rows


@query("P1_column_subset", "SELECT product_id, unit_cost FROM products_source")
def column_subset(spark, sf_dir):
    return cleaned(spark, sf_dir, "products").select("product_id", "unit_cost")


@query("P2_fact_projection", """
SELECT product_key, customer_key, store_key, date_key, quantity, unit_price, revenue, cost, profit
FROM fact_sales
""")
def fact_projection(spark, sf_dir):
    return star(spark, sf_dir).sales.select(
        "product_key", "customer_key", "store_key", "date_key",
        "quantity", "unit_price", "revenue", "cost", "profit",
    )


@query("P3_rename_price", "SELECT order_id, price AS unit_price FROM sales_clean")
def rename_price(spark, sf_dir):
    sales = cleaned(spark, sf_dir, "sales")
    return sales.withColumnRenamed("price", "unit_price").select("order_id", "unit_price")


def _measure(name):
    def run(spark, sf_dir):
        sales = cleaned(spark, sf_dir, "sales")
        return sales.select("order_id", F.col(name).cast(MEASURE).alias(name))

    return run


for _id, _name in (("P4", "revenue"), ("P5", "cost"), ("P6", "profit")):
    query(
        f"{_id}_{_name}",
        f"SELECT order_id, CAST({_name} AS {MEASURE}) AS {_name} FROM sales_clean",
    )(_measure(_name))


@query("P7_constant_stamps", "SELECT product_id, effective_date, is_current FROM dim_product")
def constant_stamps(spark, sf_dir):
    return cleaned(spark, sf_dir, "products").select("product_id", "effective_date", "is_current")


@query("P8_email_repair", "SELECT customer_id, email FROM dim_customer")
def email_repair(spark, sf_dir):
    customers = driver_tables.customers(spark, sf_dir).data
    return cleaning.repair_email(customers).select("customer_id", "email")


@query("P9_age_segment", "SELECT customer_id, customer_segment FROM dim_customer")
def age_segment(spark, sf_dir):
    customers = driver_tables.customers(spark, sf_dir).data
    band = segment(F.col("registration_date"), AS_OF).alias("customer_segment")
    return customers.select("customer_id", band)


@query("P10_full_name", """
SELECT customer_key, first_name || ' ' || last_name AS customer_name FROM dim_customer
""")
def full_name(spark, sf_dir):
    name = F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    return star(spark, sf_dir).customer.select("customer_key", name)


@query("P11_aliases", """
SELECT store_id AS id, store_name AS name, city AS place, region AS area FROM dim_store
""")
def aliases(spark, sf_dir):
    return star(spark, sf_dir).store.select(
        F.col("store_id").alias("id"),
        F.col("store_name").alias("name"),
        F.col("city").alias("place"),
        F.col("region").alias("area"),
    )


@query("Q1_null_tokens", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN NULL
                       ELSE c_mktsegment END AS cell
FROM customer
""")
def null_tokens(spark, sf_dir):
    """Two market segments are written as null tokens first."""
    written = (
        F.when(F.col("c_mktsegment") == "MACHINERY", "N/A")
        .when(F.col("c_mktsegment") == "BUILDING", "nan")
        .otherwise(F.col("c_mktsegment"))
    )
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", null_if_token(written).alias("cell"))


def some_nulls(spark, sf_dir):
    """Customers with the segment MACHINERY taken for a missing value."""
    present = F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("segment")
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", present)


@query("Q2_required_columns", """
SELECT c_custkey, c_name, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'MACHINERY'
""")
def required_columns(spark, sf_dir):
    source = Source(
        name="segments",
        file="segments.csv",
        columns={"c_custkey": "id", "c_name": "text", "segment": "text"},
        key="c_custkey",
        required=("c_custkey", "segment"),
    )
    return transforms.clean(frame_extract(some_nulls(spark, sf_dir), source, ("c_name",)), Staging(spark)).rows


@query("Q3_non_negative", """
, accounts AS (
  SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END
                         AS DECIMAL(18,6)) AS balance,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c_acctbal < 0 THEN -1 ELSE c_nationkey END AS nation
  FROM customer
), first_step AS (
  SELECT * FROM accounts
  WHERE balance >= 0 OR NOT EXISTS (SELECT 1 FROM accounts WHERE balance < 0)
)
SELECT * FROM first_step
WHERE nation >= 0 OR NOT EXISTS (SELECT 1 FROM first_step WHERE nation < 0)
""")
def non_negative(spark, sf_dir):
    """The nation is negative only in rows that the balance removes, so its NULLs stay."""
    balance = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    nation = F.when(
        F.col("c_mktsegment") != "MACHINERY",
        F.when(F.col("c_acctbal") < 0, F.lit(-1)).otherwise(F.col("c_nationkey")),
    )
    accounts = table(spark, sf_dir, "customer").select(
        "c_custkey", balance.cast("decimal(12,2)").alias("balance"), nation.alias("nation")
    )
    source = Source(
        name="balances",
        file="balances.csv",
        columns={"c_custkey": "id", "balance": "money", "nation": "int"},
        key="c_custkey",
        required=("c_custkey",),
        non_negative=("balance", "nation"),
    )
    return transforms.clean(frame_extract(accounts, source, ("balance",)), Staging(spark)).rows


@query("Q4_known_cost", """
SELECT s.order_id, CAST(s.quantity * p.unit_cost AS DECIMAL(29,6)) AS cost
FROM sales_source s JOIN products_source p ON s.product_id = p.product_id
WHERE s.copy = 1 AND p.category <> 'PROMO'
""")
def known_cost(spark, sf_dir):
    """The unit cost of one category is taken for missing; its products stay known."""
    run = build(spark, sf_dir)
    cost = F.when(F.col("category") != "PROMO", F.col("unit_cost")).alias("unit_cost")
    costs = run.cleaned["products"].rows.select("product_id", cost)
    sales = run.cleaned["sales"].rows.drop("unit_cost", "product_key", "revenue", "cost", "profit")
    priced = transforms.with_measures(sales.join(costs, "product_id", "left"))
    return priced.where(F.col("unit_cost").isNotNull()).select("order_id", "cost")


@query("Q5_has_at_sign", """
SELECT customer_id, state <> 'MACHINERY' AND contains(email, '@') AS valid FROM customers_source
""")
def has_at_sign(spark, sf_dir):
    """Addresses of one market segment are taken for missing: not valid."""
    email = F.when(F.col("state") != "MACHINERY", F.col("email"))
    customers = driver_tables.customers(spark, sf_dir).data
    return customers.select("customer_id", cleaning.has_at_sign(email).alias("valid"))


@query("Q6_recent_sales", """
SELECT sale_id, full_date FROM fact_sales JOIN dim_date USING (date_key)
WHERE full_date >= DATE '2001-08-02' - INTERVAL 90 DAY
""")
def recent_sales(spark, sf_dir):
    whole = star(spark, sf_dir)
    first = AS_OF - dt.timedelta(days=90)
    recent = reports.since(numbered(whole.sales), first)
    return recent.join(whole.date.select("date_key", "full_date"), "date_key").select(
        "sale_id", "full_date"
    )


@query("Q7_weekend_sales", """
SELECT o_orderkey, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders
""")
def weekend(spark, sf_dir):
    weekend = (F.dayofweek("o_orderdate") - 1).isin(0, 6).alias("is_weekend")
    return table(spark, sf_dir, "orders").select("o_orderkey", weekend)


@query("U1_keep_first", """
SELECT order_id, product_id, customer_id, store_id, quantity, price, order_date
FROM sales_source WHERE copy = 1
""")
def keep_first(spark, sf_dir):
    sales = driver_tables.sales(spark, sf_dir)
    first = cleaning.keep_first(sales.rows, ["order_id"], sales.order_by)
    return first.select(*sales.source.columns)


@query("U1_distinct_rows", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
""")
def distinct_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return cleaning.keep_first(
        lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    )

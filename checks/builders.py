"""B: dimension and fact builders, the whole build and its figures."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import build, query
from checks.sources import LOADED
from sparkmart.plans import facts
from sparkmart.plans.build import DAYS_AHEAD, DAYS_BACK
from sparkmart.plans.calendar import date_dimension, days_between, describe_days
from sparkmart.plans.transforms import clean
from sparkmart.schemas import Source
from sparkmart.sources.driver_tables import AS_OF, table
from sparkmart.sources.extracts import frame_extract
from sparkmart.staging import Staging


def cleaned(spark, sf_dir, name):
    return build(spark, sf_dir).cleaned[name].rows


@query("B1_products", """
SELECT product_id, product_name, category, CAST(unit_cost AS DECIMAL(18,6)) AS unit_cost,
       supplier, effective_date, is_current FROM dim_product
""")
def products(spark, sf_dir):
    return cleaned(spark, sf_dir, "products")


@query("B2_customers", """
SELECT customer_id, first_name, last_name, email, phone, city, state, registration_date,
       customer_segment FROM dim_customer
""")
def customers(spark, sf_dir):
    return cleaned(spark, sf_dir, "customers")


@query("B3_stores", """
SELECT store_id, store_name, city, state, region, manager_name, opening_date FROM dim_store
""")
def stores(spark, sf_dir):
    return cleaned(spark, sf_dir, "stores")


@query("B4_sales", """
SELECT order_id, product_id, customer_id, store_id, quantity, price, order_date, unit_cost,
       CAST(revenue AS DECIMAL(29,6)) AS revenue, CAST(cost AS DECIMAL(29,6)) AS cost,
       CAST(profit AS DECIMAL(30,6)) AS profit
FROM sales_clean
""")
def sales(spark, sf_dir):
    return cleaned(spark, sf_dir, "sales").drop("product_key")


@query("B5_date_dimension", """
, bounds AS (SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders)
SELECT dim_date.* FROM dim_date, bounds WHERE full_date BETWEEN first AND last
""")
def date_rows(spark, sf_dir):
    """One row per day from the first order to the last."""
    bounds = table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"),
        F.to_date(F.max("o_orderdate")).alias("last"),
    )
    days = bounds.select(days_between(F.col("first"), F.col("last")).alias("full_date"))
    return describe_days(days)


def _dimensions(warehouse, date):
    return facts.Dimensions(
        warehouse.table("dim_product"),
        warehouse.table("dim_customer"),
        warehouse.table("dim_store"),
        date,
    )


@query("B6_fact_rows", """
SELECT order_id, product_key, customer_key, store_key, date_key, quantity, price AS unit_price,
       CAST(revenue AS DECIMAL(29,6)) AS revenue, CAST(cost AS DECIMAL(29,6)) AS cost,
       CAST(profit AS DECIMAL(30,6)) AS profit
FROM sales_clean s
JOIN dim_product p ON s.product_id = p.product_id
JOIN dim_customer c ON s.customer_id = c.customer_id
JOIN dim_store t ON s.store_id = t.store_id
JOIN dim_date d ON s.order_date = d.full_date
""")
def fact_rows(spark, sf_dir):
    run = build(spark, sf_dir)
    unkeyed = run.cleaned["sales"].rows.drop("product_key")
    dims = _dimensions(run.warehouse, run.warehouse.table("dim_date"))
    return facts.fact_rows(unkeyed, dims)


@query("B6_unresolved", """
SELECT 'product_id' AS lookup, 0 AS unresolved
UNION ALL SELECT 'customer_id', count(*) FROM sales_clean JOIN customers_source USING (customer_id)
          WHERE state = 'MACHINERY'
UNION ALL SELECT 'store_id', count(*) FROM sales_clean JOIN stores_source USING (store_id)
          WHERE region = 'ASIA'
UNION ALL SELECT 'order_date', count(*) FROM sales_clean WHERE order_date < DATE '2001-04-04'
""")
def unresolved(spark, sf_dir):
    """One segment, one region and the days before the default window are taken for unknown."""
    run = build(spark, sf_dir)
    dims = _dimensions(run.warehouse, run.warehouse.table("dim_date"))
    fewer = facts.Dimensions(
        dims.product,
        dims.customer.where("state <> 'MACHINERY'"),
        dims.store.where("region <> 'ASIA'"),
        dims.date.where("full_date >= DATE '2001-04-04'"),
    )
    return facts.unresolved(run.cleaned["sales"].rows, fewer)


@query("B7_all_transforms", """
SELECT 'products' AS table_name, count(*) AS records, CAST(sum(product_id) AS BIGINT) AS id_sum
FROM dim_product
UNION ALL SELECT 'customers', count(*), CAST(sum(customer_id) AS BIGINT) FROM dim_customer
UNION ALL SELECT 'stores', count(*), CAST(sum(store_id) AS BIGINT) FROM dim_store
UNION ALL SELECT 'sales', count(*), CAST(sum(order_id) AS BIGINT) FROM sales_clean
""")
def all_transforms(spark, sf_dir):
    run = build(spark, sf_dir)
    sums = [
        c.rows.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("records"),
            F.sum(run.extracts[name].source.key).alias("id_sum"),
        )
        for name, c in run.cleaned.items()
    ]
    return reduce(DataFrame.unionByName, sums)


@query("B8_default_window", """
SELECT order_id, date_key FROM sales_clean JOIN dim_date ON order_date = full_date
WHERE full_date BETWEEN DATE '2001-08-02' - INTERVAL 120 DAY AND DATE '2001-08-02' + INTERVAL 30 DAY
""")
def default_window(spark, sf_dir):
    """Sales that the date window of a run without a stated range leaves in the fact."""
    run = build(spark, sf_dir)
    first, last = AS_OF - dt.timedelta(days=DAYS_BACK), AS_OF + dt.timedelta(days=DAYS_AHEAD)
    days = date_dimension(spark, first, last)
    return facts.fact_rows(run.cleaned["sales"].rows, _dimensions(run.warehouse, days)).select(
        "order_id", "date_key"
    )


@query("B9_star_build", f"""
SELECT table_name, records, 'SUCCESS' AS status FROM ({LOADED.strip()})
""")
def star_build(spark, sf_dir):
    run = build(spark, sf_dir)
    inserted = run.stats_frame("load").where("metric = 'records_inserted'")
    return inserted.select(
        "table_name", F.col("value").alias("records"), F.lit(run.status).alias("status")
    )


TRANSFORMED = """
, counts(table_name, input_records, output_records) AS (
  SELECT 'products', count(*), count(*) FROM dim_product
  UNION ALL SELECT 'customers', count(*), count(*) FROM dim_customer
  UNION ALL SELECT 'stores', count(*), count(*) FROM dim_store
  UNION ALL SELECT 'sales', (SELECT count(*) FROM sales_source), count(*) FROM sales_clean
), transformed(table_name, metric, value) AS (
  SELECT table_name, 'input_records', input_records FROM counts
  UNION ALL SELECT table_name, 'output_records', output_records FROM counts
  UNION ALL SELECT table_name, 'removed_records', input_records - output_records FROM counts
  UNION ALL SELECT 'customers', 'invalid_emails', count(*) FROM customers_source WHERE NOT contains(email, '@')
)
"""

LOAD_STATS = f"""
, loaded(table_name, metric, value) AS (
  SELECT table_name, 'records_inserted', records FROM ({LOADED.strip()})
  UNION ALL SELECT 'dim_product', 'records_source', count(*) FROM dim_product
  UNION ALL SELECT 'dim_customer', 'records_source', count(*) FROM dim_customer
  UNION ALL SELECT 'dim_store', 'records_source', count(*) FROM dim_store
  UNION ALL SELECT 'fact_sales', 'records_source', count(*) FROM sales_clean
)
"""


@query("B10_transform_stats", TRANSFORMED + "SELECT * FROM transformed")
def transform_stats(spark, sf_dir):
    return build(spark, sf_dir).stats_frame("transform").drop("stage")


@query("B11_validation_errors", """
SELECT 'balance' AS column_name, count(*) AS negatives,
       'Found ' || count(*) || ' negative values in balance' AS message
FROM customer WHERE c_acctbal < 0
""")
def validation_errors(spark, sf_dir):
    accounts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), F.col("c_acctbal").alias("balance")
    )
    source = Source(
        name="accounts",
        file="accounts.csv",
        columns={"account_id": "id", "balance": "money"},
        key="account_id",
        required=("account_id",),
        non_negative=("balance",),
    )
    result = clean(frame_extract(accounts, source, ("balance",)), Staging(spark))
    rows = [(c, n, m) for (c, n), m in zip(result.negatives.items(), result.messages)]
    return spark.createDataFrame(rows, "column_name STRING, negatives BIGINT, message STRING")


@query("B12_load_stats", LOAD_STATS + "SELECT * FROM loaded")
def load_stats(spark, sf_dir):
    return build(spark, sf_dir).stats_frame("load").drop("stage")


@query("B13_run_summary", TRANSFORMED + LOAD_STATS + """
SELECT 'transform' AS stage, * FROM transformed
UNION ALL SELECT 'load', * FROM loaded
UNION ALL SELECT 'extract', table_name, 'records', value FROM transformed
          WHERE metric = 'input_records'
UNION ALL SELECT * FROM (VALUES ('extract', 'sales', 'columns', 7),
  ('extract', 'customers', 'columns', 8), ('extract', 'products', 'columns', 5),
  ('extract', 'stores', 'columns', 7))
""")
def run_summary(spark, sf_dir):
    """The figures; status and times of the run stand beside them in summary_frame."""
    return build(spark, sf_dir).stats_frame()

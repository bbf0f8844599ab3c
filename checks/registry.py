"""The list of queries, the star they share, and the SQL form of the same star."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators.keys import dense_keys
from sparkmart.plans.build import StarBuild
from sparkmart.plans.warehouse import Warehouse
from sparkmart.sources import driver_tables
from sparkmart.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_BUILDS: dict[tuple[str, str], StarBuild] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL with the same result."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = f"{STAR}\n{sql.strip()}"
        return function

    return register


def build(spark: SparkSession, sf_dir: str) -> StarBuild:
    """The star of all test tables, built by the library once per Spark application."""
    application = (spark.sparkContext.applicationId, sf_dir)
    if application not in _BUILDS:
        staging = Staging(spark)
        database = f"mart_{uuid.uuid4().hex[:12]}"
        warehouse = Warehouse(spark, database, location=staging.path("warehouse"))
        run = StarBuild(
            driver_tables.extracts(spark, sf_dir),
            warehouse,
            as_of=driver_tables.AS_OF,
            date_range=driver_tables.DATE_RANGE,
            staging=staging,
            keep_staged=True,  # queries read the cleaned rows
        )
        _BUILDS[application] = run.run()
    return _BUILDS[application]


def star(spark: SparkSession, sf_dir: str):
    return build(spark, sf_dir).warehouse.star()


def numbered(sales: DataFrame) -> DataFrame:
    """The fact with sale_id as 1..n in its order: the stored ids are unique and rise with (date,
    order), which is what the SQL compares, but have gaps."""
    position = sales.withColumnRenamed("sale_id", "position")
    return dense_keys(position, "sale_id", ["position"], Staging(sales.sparkSession), "numbered").drop("position")


def half_away(top: str, bottom: str) -> str:
    """SQL for top / bottom as hundredths, in whole numbers, rounded half away from zero."""
    s, n = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    return (
        f"CAST(CAST(sign({s}) * ((2 * abs({s}) + {n}) // nullif(2 * {n}, 0)) AS DECIMAL(28,0))"
        " * 0.01 AS DECIMAL(18,2))"
    )


def avg2(total: str, count: str) -> str:
    return half_away(f"{total} * 100", count)


def pct2(part: str, base: str) -> str:
    return half_away(f"{part} * 1000000", f"{base} * 100")


STAR = """
WITH sales_source AS (
  SELECT l_orderkey * 8 + l_linenumber AS order_id, l_partkey AS product_id,
         o_custkey AS customer_id, l_suppkey AS store_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,6)) AS price,
         CAST(o_orderdate AS DATE) AS order_date,
         row_number() OVER (
           PARTITION BY l_orderkey * 8 + l_linenumber
           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_returnflag, l_linestatus) AS copy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), products_source AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,6)) AS unit_cost, p_brand AS supplier
  FROM part
), customers_source AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         c_custkey || CASE WHEN c_custkey % 10 = 0 THEN '' ELSE '@' END || 'x.test' AS email,
         CAST(NULL AS VARCHAR) AS phone, CAST(c_nationkey AS VARCHAR) AS city,
         c_mktsegment AS state,
         DATE '2001-08-02' - CAST(c_custkey % 500 AS INTEGER) AS registration_date
  FROM customer
), stores_source AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS city,
         CAST(n_nationkey AS VARCHAR) AS state, r_name AS region,
         CAST(NULL AS VARCHAR) AS manager_name, DATE '1995-01-01' AS opening_date
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
), sales_clean AS (
  SELECT s.order_id, s.product_id, s.customer_id, s.store_id, s.quantity, s.price, s.order_date,
         p.unit_cost, s.quantity * s.price AS revenue, s.quantity * p.unit_cost AS cost,
         s.quantity * s.price - s.quantity * p.unit_cost AS profit
  FROM sales_source s JOIN products_source p ON s.product_id = p.product_id
  WHERE s.copy = 1
), dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name,
         category, CAST(unit_cost AS DECIMAL(10,2)) AS unit_cost, supplier,
         DATE '2001-08-02' AS effective_date, true AS is_current
  FROM products_source
), dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, first_name,
         last_name, CASE WHEN email LIKE '%@%' THEN email ELSE 'invalid@email.com' END AS email,
         phone, city, state, registration_date,
         CASE WHEN DATE '2001-08-02' - registration_date <= 0 THEN NULL
              WHEN DATE '2001-08-02' - registration_date <= 30 THEN 'New'
              WHEN DATE '2001-08-02' - registration_date <= 90 THEN 'Recent'
              WHEN DATE '2001-08-02' - registration_date <= 365 THEN 'Established'
              ELSE 'Loyal' END AS customer_segment
  FROM customers_source
), dim_store AS (
  SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_name, city, state,
         region, manager_name, opening_date
  FROM stores_source
), days AS (
  SELECT CAST(d AS DATE) AS full_date
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-09-01', INTERVAL 1 DAY) g(d)
), dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month,
         rpad(monthname(full_date), 9, ' ') AS month_name,
         CAST(day(full_date) AS INTEGER) AS day,
         CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
         rpad(dayname(full_date), 9, ' ') AS day_name,
         CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         dayofweek(full_date) IN (0, 6) AS is_weekend,
         CAST(year(full_date) AS INTEGER) AS fiscal_year
  FROM days
), fact_sales AS (
  SELECT row_number() OVER (ORDER BY date_key, order_id) AS sale_id, product_key, customer_key,
         store_key, date_key, quantity, CAST(price AS DECIMAL(10,2)) AS unit_price,
         CAST(revenue AS DECIMAL(10,2)) AS revenue, CAST(cost AS DECIMAL(10,2)) AS cost,
         CAST(profit AS DECIMAL(10,2)) AS profit,
         CAST(date_key // 100 AS INTEGER) AS date_month
  FROM sales_clean s
  JOIN dim_product p ON s.product_id = p.product_id
  JOIN dim_customer c ON s.customer_id = c.customer_id
  JOIN dim_store t ON s.store_id = t.store_id
  JOIN dim_date d ON s.order_date = d.full_date
)
""".strip()

"""The transforms that the build runs, over rows with copies, gaps, negatives and unknown keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import query
from sparkmart.plans import transforms
from sparkmart.schemas import SOURCES
from sparkmart.sources import driver_tables
from sparkmart.sources.driver_tables import AS_OF
from sparkmart.sources.extracts import Extract, frame_extract
from sparkmart.staging import Staging


def every(n: int, key: str):
    """True in every n-th row by key."""
    return F.col(key) % n == 0


def _with_copies(rows: DataFrame, key: str, n: int, changed: dict[str, object]) -> DataFrame:
    """Rows at position 1 and, of every n-th, a changed copy at position 2."""
    copies = rows.where(every(n, key)).withColumns({c: F.lit(v) for c, v in changed.items()})
    return rows.withColumn("position", F.lit(1)).unionByName(copies.withColumn("position", F.lit(2)))


def _extract(name: str, rows: DataFrame) -> Extract:
    return frame_extract(rows, SOURCES[name], ("position",))


def products(spark, sf_dir) -> Extract:
    rows = driver_tables.products(spark, sf_dir).data
    cost = F.when(every(11, "product_id"), None).when(every(13, "product_id"), -F.col("unit_cost"))
    dirty = rows.withColumns({
        "unit_cost": cost.otherwise(F.col("unit_cost")),
        "category": F.when(~every(17, "product_id"), F.col("category")),
    })
    return _extract("products", _with_copies(dirty, "product_id", 7, {"product_name": "copy", "category": "copy"}))


def customers(spark, sf_dir) -> Extract:
    rows = driver_tables.customers(spark, sf_dir).data
    dirty = rows.withColumns({
        "email": F.when(~every(9, "customer_id"), F.col("email")),
        "last_name": F.when(~every(8, "customer_id"), F.col("last_name")),
    })
    return _extract("customers", _with_copies(dirty, "customer_id", 6, {"email": "no address", "last_name": "copy"}))


def stores(spark, sf_dir) -> Extract:
    rows = driver_tables.stores(spark, sf_dir).data
    dirty = rows.withColumn("region", F.when(~every(5, "store_id"), F.col("region")))
    return _extract("stores", _with_copies(dirty, "store_id", 4, {"region": "copy"}))


def sales(spark, sf_dir) -> Extract:
    extract = driver_tables.sales(spark, sf_dir)
    dirty = extract.rows.withColumns({
        "quantity": F.when(every(19, "order_id"), -F.col("quantity")).otherwise(F.col("quantity")),
        "price": F.when(~every(23, "order_id"), F.col("price")),
        "product_id": F.when(every(29, "order_id"), F.lit(-1)).otherwise(F.col("product_id")),
        "store_id": F.when(~every(31, "order_id"), F.col("store_id")),
    })
    return frame_extract(dirty, SOURCES["sales"], extract.order_by)


DIRTY = """
, products_rows AS (
  SELECT product_id, product_name, CASE WHEN product_id % 17 <> 0 THEN category END AS category,
         CASE WHEN product_id % 11 = 0 THEN NULL WHEN product_id % 13 = 0 THEN -unit_cost
              ELSE unit_cost END AS unit_cost, supplier, 1 AS position
  FROM products_source
), products_first AS (
  SELECT * FROM (SELECT * FROM products_rows UNION ALL
                 SELECT * REPLACE ('copy' AS product_name, 'copy' AS category, 2 AS position)
                 FROM products_rows WHERE product_id % 7 = 0)
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY position) = 1
), products_kept AS (
  SELECT * EXCLUDE (position) FROM products_first WHERE category IS NOT NULL AND unit_cost >= 0
), customers_rows AS (
  SELECT * REPLACE (CASE WHEN customer_id % 9 <> 0 THEN email END AS email,
                    CASE WHEN customer_id % 8 <> 0 THEN last_name END AS last_name), 1 AS position
  FROM customers_source
), customers_first AS (
  SELECT * FROM (SELECT * FROM customers_rows UNION ALL
                 SELECT * REPLACE ('no address' AS email, 'copy' AS last_name, 2 AS position)
                 FROM customers_rows WHERE customer_id % 6 = 0)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY position) = 1
), customers_kept AS (
  SELECT * EXCLUDE (position) FROM customers_first WHERE email IS NOT NULL AND last_name IS NOT NULL
), stores_rows AS (
  SELECT * REPLACE (CASE WHEN store_id % 5 <> 0 THEN region END AS region), 1 AS position FROM stores_source
), stores_first AS (
  SELECT * FROM (SELECT * FROM stores_rows UNION ALL
                 SELECT * REPLACE ('copy' AS region, 2 AS position) FROM stores_rows WHERE store_id % 4 = 0)
  QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY position) = 1
), stores_kept AS (SELECT * EXCLUDE (position) FROM stores_first WHERE region IS NOT NULL
), sales_rows AS (
  SELECT * REPLACE (CAST(CASE WHEN order_id % 19 = 0 THEN -quantity ELSE quantity END AS INTEGER) AS quantity,
                    CASE WHEN order_id % 23 <> 0 THEN price END AS price,
                    CASE WHEN order_id % 29 = 0 THEN -1 ELSE product_id END AS product_id,
                    CASE WHEN order_id % 31 <> 0 THEN store_id END AS store_id)
  FROM sales_source
), sales_complete AS (SELECT * FROM sales_rows WHERE copy = 1 AND store_id IS NOT NULL
), sales_kept AS (
  SELECT s.* EXCLUDE (copy), unit_cost FROM sales_complete s JOIN products_kept USING (product_id)
  WHERE quantity >= 0
)
"""


def _products(spark, sf_dir) -> transforms.Cleaned:
    return transforms.transform_products(products(spark, sf_dir), AS_OF, Staging(spark))


@query("B1_dirty", DIRTY + """
SELECT *, DATE '2001-08-02' AS effective_date, true AS is_current FROM products_kept
""")
def dirty_products(spark, sf_dir):
    return _products(spark, sf_dir).rows


@query("B2_dirty", DIRTY + """
SELECT k.* REPLACE (CASE WHEN contains(email, '@') THEN email ELSE 'invalid@email.com' END AS email),
       d.customer_segment
FROM customers_kept k JOIN (SELECT customer_id, customer_segment FROM dim_customer) d USING (customer_id)
""")
def dirty_customers(spark, sf_dir):
    return transforms.transform_customers(customers(spark, sf_dir), AS_OF, Staging(spark)).rows


@query("B3_dirty", DIRTY + "SELECT * FROM stores_kept")
def dirty_stores(spark, sf_dir):
    return transforms.transform_stores(stores(spark, sf_dir), Staging(spark)).rows


@query("B4_dirty", DIRTY + """
SELECT *, CAST(quantity * price AS DECIMAL(29,6)) AS revenue, CAST(quantity * unit_cost AS DECIMAL(29,6)) AS cost,
       CAST(quantity * price - quantity * unit_cost AS DECIMAL(30,6)) AS profit
FROM sales_kept
""")
def dirty_sales(spark, sf_dir):
    costs = _products(spark, sf_dir).rows
    return transforms.transform_sales(sales(spark, sf_dir), costs, Staging(spark)).rows


@query("B7_dirty_counts", DIRTY + """
, counts(table_name, metric, value) AS (
  SELECT 'products', 'input', (SELECT count(*) + count_if(product_id % 7 = 0) FROM products_rows)
  UNION ALL SELECT 'products', 'output', (SELECT count(*) FROM products_kept)
  UNION ALL SELECT 'products', 'nulls_category', (SELECT count_if(category IS NULL) FROM products_first)
  UNION ALL SELECT 'products', 'negative_unit_cost',
                   (SELECT count_if(unit_cost < 0) FROM products_first WHERE category IS NOT NULL)
  UNION ALL SELECT 'customers', 'input', (SELECT count(*) + count_if(customer_id % 6 = 0) FROM customers_rows)
  UNION ALL SELECT 'customers', 'output', (SELECT count(*) FROM customers_kept)
  UNION ALL SELECT 'customers', 'nulls_email', (SELECT count_if(email IS NULL) FROM customers_first)
  UNION ALL SELECT 'customers', 'nulls_last_name', (SELECT count_if(last_name IS NULL) FROM customers_first)
  UNION ALL SELECT 'customers', 'invalid_emails', (SELECT count_if(NOT contains(email, '@')) FROM customers_kept)
  UNION ALL SELECT 'stores', 'input', (SELECT count(*) + count_if(store_id % 4 = 0) FROM stores_rows)
  UNION ALL SELECT 'stores', 'output', (SELECT count(*) FROM stores_kept)
  UNION ALL SELECT 'stores', 'nulls_region', (SELECT count_if(region IS NULL) FROM stores_first)
  UNION ALL SELECT 'sales', 'input', (SELECT count(*) FROM sales_rows)
  UNION ALL SELECT 'sales', 'output', (SELECT count(*) FROM sales_kept)
  UNION ALL SELECT 'sales', 'nulls_store_id', (SELECT count_if(store_id IS NULL) FROM sales_rows WHERE copy = 1)
  UNION ALL SELECT 'sales', 'negative_quantity', (SELECT count_if(quantity < 0) FROM sales_complete)
)
SELECT table_name, metric, CAST(value AS BIGINT) AS value FROM counts WHERE value > 0
""")
def dirty_counts(spark, sf_dir):
    """What cleaning counted: rows in and out, missing values, negatives, repaired addresses."""
    cleaned = {
        "products": _products(spark, sf_dir),
        "customers": transforms.transform_customers(customers(spark, sf_dir), AS_OF, Staging(spark)),
        "stores": transforms.transform_stores(stores(spark, sf_dir), Staging(spark)),
    }
    cleaned["sales"] = transforms.transform_sales(
        sales(spark, sf_dir), cleaned["products"].rows, Staging(spark)
    )

    def counted(name: str, c: transforms.Cleaned) -> DataFrame:
        """The output is counted by Spark; the other figures were observed in the write."""
        negatives = {f"negative_{column}": n for column, n in c.negatives.items()}
        figures = {"input": c.input, **c.figures, **negatives}
        listed = spark.createDataFrame(
            [(name, k, v) for k, v in figures.items() if v], "table_name STRING, metric STRING, value BIGINT"
        )
        return listed.unionByName(
            c.rows.agg(F.lit(name).alias("table_name"), F.lit("output").alias("metric"), F.count(F.lit(1)).alias("value"))
        )

    return reduce(DataFrame.unionByName, [counted(n, c) for n, c in cleaned.items()]).where("value > 0")

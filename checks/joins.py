"""J and L: joins, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import avg2, build, numbered, query, star
from sparkmart.functions.money import average, sum_money
from sparkmart.operators.joins import absent_from, lookup, with_group_figures
from sparkmart.operators.keys import POSITION, number_rows
from sparkmart.plans import reports
from sparkmart.sources import driver_tables
from sparkmart.sources.driver_tables import table
from sparkmart.staging import Staging

MONEY = "DECIMAL(28,2)"


@query("J1_sales_with_cost", """
SELECT s.order_id, s.product_id, p.unit_cost
FROM sales_source s LEFT JOIN products_source p ON s.product_id = p.product_id
  AND p.category <> 'PROMO'
WHERE s.copy = 1
""")
def sales_with_cost(spark, sf_dir):
    """Products of one category are taken for unknown, so their sales have no cost."""
    run = build(spark, sf_dir)
    known = run.cleaned["products"].rows.where("category <> 'PROMO'")
    sales = run.cleaned["sales"].rows.select("order_id", "product_id")
    return lookup(sales, known, "product_id", ["unit_cost"], how="left")


def _key_lookup(dimension, natural, surrogate):
    def run(spark, sf_dir):
        built = build(spark, sf_dir)
        sales = built.cleaned["sales"].rows.select("order_id", natural)
        keyed = lookup(sales, built.warehouse.table(dimension), natural, [surrogate])
        return keyed.select("order_id", surrogate)

    return run


for _id, _dimension in (("J2", "product"), ("J3", "customer"), ("J4", "store")):
    _natural, _surrogate = f"{_dimension}_id", f"{_dimension}_key"
    query(
        f"{_id}_{_dimension}_key",
        f"SELECT s.order_id, d.{_surrogate} FROM sales_clean s"
        f" JOIN dim_{_dimension} d ON s.{_natural} = d.{_natural}",
    )(_key_lookup(f"dim_{_dimension}", _natural, _surrogate))


@query("J5_date_key", """
SELECT o_orderkey, date_key FROM orders
JOIN dim_date ON CAST(o_orderdate AS DATE) = full_date
WHERE full_date >= DATE '2000-01-01'
""")
def date_key(spark, sf_dir):
    """The order timestamp is cut to its date; orders before the dimension's first day vanish."""
    days = star(spark, sf_dir).date.where("full_date >= DATE '2000-01-01'")
    orders = table(spark, sf_dir, "orders")
    dated = orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    keyed = lookup(dated, days, "order_date", ["date_key"], table_key="full_date")
    return keyed.select("o_orderkey", "date_key")


@query("J6_fact_with_dimension", """
SELECT sale_id, category, revenue FROM fact_sales JOIN dim_product USING (product_key)
""")
def fact_with_dimension(spark, sf_dir):
    whole = star(spark, sf_dir)
    sales = numbered(whole.sales)
    return lookup(sales, whole.product, "product_key", ["category"]).select(
        "sale_id", "category", "revenue"
    )


@query("J7_star_join", f"""
SELECT year, category, dim_customer.state AS customer_state, region, count(*) AS sales,
       CAST(sum(revenue) AS {MONEY}) AS revenue
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
JOIN dim_customer USING (customer_key) JOIN dim_store USING (store_key)
GROUP BY ALL
""")
def star_join(spark, sf_dir):
    whole = star(spark, sf_dir)
    customers = whole.customer.withColumnRenamed("state", "customer_state")
    joined = lookup(whole.sales, whole.date, "date_key", ["year"])
    joined = lookup(joined, whole.product, "product_key", ["category"])
    joined = lookup(joined, customers, "customer_key", ["customer_state"])
    joined = lookup(joined, whole.store, "store_key", ["region"])
    return joined.groupBy("year", "category", "customer_state", "region").agg(
        F.count(F.lit(1)).alias("sales"), sum_money("revenue").alias("revenue")
    )


@query("J8_customer_figures", f"""
, order_stats AS (
  SELECT customer_key, count(*) AS orders, sum(revenue) AS spent
  FROM fact_sales GROUP BY customer_key
)
SELECT sale_id, orders, {avg2('spent', 'orders')} AS avg_order_value
FROM fact_sales JOIN order_stats USING (customer_key)
""")
def customer_figures(spark, sf_dir):
    sales = numbered(star(spark, sf_dir).sales.select("sale_id", "customer_key", "revenue"))
    figures = {
        "orders": F.count(F.lit(1)),
        "avg_order_value": average(sum_money("revenue"), F.count(F.lit(1))),
    }
    with_figures = with_group_figures(
        sales, ["customer_key"], Staging(spark), "order_stats", **figures
    )
    return with_figures.select("sale_id", "orders", "avg_order_value")


@query("J9_absent_rows", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN
  (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F')
""")
def absent_rows(spark, sf_dir):
    """Order days on which no order is finished."""
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate").alias("full_date")
    finished = orders.where("o_orderstatus = 'F'").select(day).distinct()
    return absent_from(orders.select(day).distinct(), finished, "full_date")


def placed(rows):
    """Sorted rows with their places, 1..n in the order they have."""
    positions = rows.withColumn(POSITION, F.monotonically_increasing_id())
    staged, _ = Staging(rows.sparkSession).write(positions, "sorted")
    return number_rows(staged, "place")


@query("L1_one_measure", f"""
SELECT row_number() OVER (ORDER BY revenue DESC, region) AS place, region, revenue
FROM (SELECT region, CAST(sum(revenue) AS {MONEY}) AS revenue
      FROM fact_sales JOIN dim_store USING (store_key) GROUP BY region)
""")
def one_measure(spark, sf_dir):
    """The order itself is part of the result: each row has its place."""
    sorted_rows = reports.revenue_per_region(star(spark, sf_dir))
    return placed(sorted_rows).select("place", "region", F.col("total_revenue").alias("revenue"))


@query("L2_two_keys", """
SELECT row_number() OVER (ORDER BY year DESC, month DESC) AS place, year, month
FROM (SELECT DISTINCT year, month FROM fact_sales JOIN dim_date USING (date_key))
""")
def two_keys(spark, sf_dir):
    sorted_rows = reports.monthly_sales_trends(star(spark, sf_dir))
    return placed(sorted_rows).select("place", "year", "month")


@query("L3_by_date", """
SELECT row_number() OVER (ORDER BY full_date DESC) AS place, full_date
FROM (SELECT DISTINCT full_date FROM fact_sales JOIN dim_date USING (date_key)
      WHERE full_date >= DATE '2001-08-02' - INTERVAL 30 DAY)
""")
def by_date(spark, sf_dir):
    sorted_rows = reports.daily_sales_summary(star(spark, sf_dir), 30, driver_tables.AS_OF)
    return placed(sorted_rows).select("place", "full_date")


@query("L4_top_k", f"""
SELECT product_name, CAST(sum(revenue) AS {MONEY}) AS total_revenue
FROM fact_sales JOIN dim_product USING (product_key)
GROUP BY product_key, product_name ORDER BY sum(revenue) DESC, product_key LIMIT 25
""")
def top_k(spark, sf_dir):
    best = reports.top_selling_products(star(spark, sf_dir), 25)
    return best.select("product_name", "total_revenue")


@query("L5_preview", """
SELECT order_id, product_id, quantity FROM sales_clean ORDER BY order_id LIMIT 3
""")
def preview(spark, sf_dir):
    """The first three rows."""
    sales = build(spark, sf_dir).cleaned["sales"].rows
    return sales.orderBy("order_id").limit(3).select("order_id", "product_id", "quantity")

"""R, V and N: reports, views and named queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import ORACLES, QUERIES, STAR, avg2, pct2, query, star
from sparkmart.plans import reports
from sparkmart.sources.driver_tables import AS_OF

MONEY = "DECIMAL(28,2)"


@query("R1_top_selling_products", f"""
SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       {avg2('sum(unit_price)', 'count(*)')} AS avg_selling_price
FROM fact_sales JOIN dim_product USING (product_key)
GROUP BY product_key, product_name, category ORDER BY sum(revenue) DESC, product_key LIMIT 10
""")
def top_selling_products(spark, sf_dir):
    return reports.top_selling_products(star(spark, sf_dir), 10)


@query("R2_revenue_by_region", f"""
SELECT region, count(DISTINCT sale_id) AS total_transactions,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       {avg2('sum(revenue)', 'count(*)')} AS avg_transaction_value
FROM fact_sales JOIN dim_store USING (store_key) GROUP BY region ORDER BY total_revenue DESC
""")
def revenue_by_region(spark, sf_dir):
    return reports.revenue_by_region(star(spark, sf_dir))


MONTHS = f"""
SELECT year, month, month_name, count(*) AS total_transactions,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       {avg2('sum(revenue)', 'count(*)')} AS avg_revenue_per_transaction
FROM fact_sales JOIN dim_date USING (date_key) GROUP BY year, month, month_name
"""


@query("R3_monthly_sales_trends", MONTHS + "ORDER BY year DESC, month DESC")
def monthly_sales_trends(spark, sf_dir):
    return reports.monthly_sales_trends(star(spark, sf_dir))


@query("R4_sales_by_store", f"""
SELECT store_name, city, state, region, count(*) AS total_transactions,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       {avg2('sum(revenue)', 'count(*)')} AS avg_transaction_value
FROM fact_sales JOIN dim_store USING (store_key)
GROUP BY store_key, store_name, city, state, region ORDER BY total_revenue DESC
""")
def sales_by_store(spark, sf_dir):
    return reports.sales_by_store(star(spark, sf_dir))


# The averages as the report states them: each sale carries its customer's figures.
@query("R5_customer_purchasing_patterns", f"""
, order_stats AS (
  SELECT customer_key, count(*) AS orders, sum(revenue) AS spent
  FROM fact_sales GROUP BY customer_key
)
SELECT customer_segment, count(DISTINCT customer_key) AS customer_count,
       count(sale_id) AS total_orders,
       {avg2('sum(orders)', 'count(*)')} AS avg_orders_per_customer,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(round(sum(CAST(spent AS DOUBLE) / orders) / count(*), 2) AS DECIMAL(18,2))
         AS avg_order_value
FROM fact_sales JOIN dim_customer USING (customer_key) JOIN order_stats USING (customer_key)
GROUP BY customer_segment ORDER BY total_revenue DESC
""")
def customer_purchasing_patterns(spark, sf_dir):
    return reports.customer_purchasing_patterns(star(spark, sf_dir))


@query("R6_top_customers", f"""
SELECT first_name || ' ' || last_name AS customer_name, email, city, state, customer_segment,
       count(sale_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_purchased,
       CAST(sum(revenue) AS {MONEY}) AS total_spent,
       {avg2('sum(revenue)', 'count(*)')} AS avg_order_value
FROM fact_sales JOIN dim_customer USING (customer_key)
GROUP BY customer_key, first_name, last_name, email, city, state, customer_segment
ORDER BY total_spent DESC, customer_key LIMIT 10
""")
def top_customers(spark, sf_dir):
    return reports.top_customers(star(spark, sf_dir), 10)


@query("R7_category_performance", f"""
SELECT category, count(DISTINCT product_key) AS product_count, count(sale_id) AS total_sales,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       {avg2('sum(profit)', 'count(*)')} AS avg_profit_per_sale,
       {pct2('sum(profit)', 'sum(revenue)')} AS profit_margin_pct
FROM fact_sales JOIN dim_product USING (product_key) GROUP BY category ORDER BY total_revenue DESC
""")
def category_performance(spark, sf_dir):
    return reports.category_performance(star(spark, sf_dir))


@query("R8_daily_sales_summary", f"""
SELECT full_date, day_name, count(*) AS transactions, CAST(sum(quantity) AS BIGINT) AS units_sold,
       CAST(sum(revenue) AS {MONEY}) AS revenue, CAST(sum(profit) AS {MONEY}) AS profit
FROM fact_sales JOIN dim_date USING (date_key)
WHERE full_date >= DATE '2001-08-02' - INTERVAL 30 DAY
GROUP BY full_date, day_name ORDER BY full_date DESC
""")
def daily_sales_summary(spark, sf_dir):
    return reports.daily_sales_summary(star(spark, sf_dir), 30, AS_OF)


@query("R9_executive_summary", f"""
SELECT count(*) AS total_transactions, CAST(sum(revenue) AS {MONEY}) AS total_revenue,
       CAST(sum(profit) AS {MONEY}) AS total_profit,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       count(DISTINCT customer_key) AS unique_customers,
       count(DISTINCT product_key) AS products_sold,
       {avg2('sum(revenue)', 'count(*)')} AS avg_transaction_value,
       {pct2('sum(profit)', 'sum(revenue)')} AS overall_profit_margin
FROM fact_sales
""")
def executive_summary(spark, sf_dir):
    return reports.executive_summary(star(spark, sf_dir))


@query("V1_sales_summary_view", """
SELECT full_date, month_name, year, product_name, category, dim_customer.city AS customer_city,
       store_name, region, quantity, revenue, profit
FROM fact_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
JOIN dim_customer USING (customer_key) JOIN dim_store USING (store_key)
""")
def sales_summary(spark, sf_dir):
    return reports.sales_summary(star(spark, sf_dir))


@query("V2_monthly_revenue_view", MONTHS)
def monthly_revenue(spark, sf_dir):
    return reports.monthly_revenue(star(spark, sf_dir))


NAMED = {
    "N1_top_products": ("top_products", f"""
SELECT product_name, CAST(sum(revenue) AS {MONEY}) AS total_revenue
FROM fact_sales JOIN dim_product USING (product_key)
GROUP BY product_name ORDER BY total_revenue DESC, product_name LIMIT 10"""),
    "N2_revenue_by_region": ("revenue_by_region", f"""
SELECT region, CAST(sum(revenue) AS {MONEY}) AS total_revenue
FROM fact_sales JOIN dim_store USING (store_key) GROUP BY region ORDER BY total_revenue DESC"""),
    "N3_monthly_trends": ("monthly_trends", f"""
SELECT year, month, CAST(sum(revenue) AS {MONEY}) AS total_revenue
FROM fact_sales JOIN dim_date USING (date_key)
GROUP BY year, month ORDER BY year DESC, month DESC"""),
    "N4_customer_insights": ("customer_insights", f"""
SELECT customer_segment, count(DISTINCT customer_key) AS customer_count,
       CAST(sum(revenue) AS {MONEY}) AS total_revenue
FROM fact_sales JOIN dim_customer USING (customer_key) GROUP BY customer_segment"""),
}

for _key, (_name, _sql) in NAMED.items():
    query(_key, _sql)(
        lambda spark, sf_dir, name=_name: reports.NAMED_QUERIES[name](star(spark, sf_dir))
    )

REPORT_KEYS = {
    "executive_summary": "R9_executive_summary",
    "top_products": "R1_top_selling_products",
    "revenue_by_region": "R2_revenue_by_region",
    "monthly_trends": "R3_monthly_sales_trends",
    "store_performance": "R4_sales_by_store",
    "customer_patterns": "R5_customer_purchasing_patterns",
    "top_customers": "R6_top_customers",
    "category_performance": "R7_category_performance",
    "daily_summary": "R8_daily_sales_summary",
}


def _report_rows_sql() -> str:
    """Rows per report, from the SQL of each."""
    parts = [
        f"SELECT '{report}' AS report, count(*) AS row_count FROM ({ORACLES[key]})"
        for report, key in REPORT_KEYS.items()
    ]
    return "\nUNION ALL ".join(parts)


def full_report(spark, sf_dir) -> DataFrame:
    """Rows per report of the whole bundle."""
    bundle = reports.full_report(star(spark, sf_dir), AS_OF)
    counts = [
        df.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("row_count"))
        for name, df in bundle.items()
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES["R10_full_report"] = full_report
ORACLES["R10_full_report"] = _report_rows_sql()
assert all(sql.startswith(STAR) for key, sql in ORACLES.items() if key != "R10_full_report")

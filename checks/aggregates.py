"""A and G: aggregates and grouping forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import avg2, build, pct2, query, star
from sparkmart.functions.money import average, percent, sum_money, total
from sparkmart.operators.cleaning import has_at_sign
from sparkmart.plans.reports import per_key
from sparkmart.sources.driver_tables import table

MONEY = "DECIMAL(28,2)"


@query("A1_sum_int", """
SELECT store_key, CAST(sum(quantity) AS BIGINT) AS units FROM fact_sales GROUP BY store_key
""")
def sum_int(spark, sf_dir):
    return per_key(star(spark, sf_dir).sales, "store_key").select("store_key", "units")


@query("A2_sum_money", f"""
SELECT product_key, CAST(sum(revenue) AS {MONEY}) AS revenue,
       CAST(sum(profit) AS {MONEY}) AS profit
FROM fact_sales GROUP BY product_key
""")
def money_sums(spark, sf_dir):
    sales = star(spark, sf_dir).sales
    return per_key(sales, "product_key").select("product_key", "revenue", "profit")


@query("A3_count_rows", "SELECT date_key, count(*) AS sales FROM fact_sales GROUP BY date_key")
def count_rows(spark, sf_dir):
    sales = star(spark, sf_dir).sales
    return sales.groupBy("date_key").agg(F.count(F.lit(1)).alias("sales"))


@query("A4_count_values", """
SELECT c_nationkey, count(CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1 END) AS segments
FROM customer GROUP BY c_nationkey
""")
def count_values(spark, sf_dir):
    present = F.nullif("c_mktsegment", F.lit("MACHINERY"))
    customers = table(spark, sf_dir, "customer")
    return customers.groupBy("c_nationkey").agg(F.count(present).alias("segments"))


@query("A5_count_distinct", """
SELECT store_key, count(DISTINCT customer_key) AS customers FROM fact_sales GROUP BY store_key
""")
def count_distinct(spark, sf_dir):
    sales = star(spark, sf_dir).sales
    return sales.groupBy("store_key").agg(F.count_distinct("customer_key").alias("customers"))


@query("A6_count_distinct_of_key", """
SELECT customer_key, count(DISTINCT sale_id) AS sales FROM fact_sales GROUP BY customer_key
""")
def count_distinct_of_key(spark, sf_dir):
    """The sale id is unique, so counting it gives the distinct count without its shuffle."""
    sales = star(spark, sf_dir).sales
    return sales.groupBy("customer_key").agg(F.count("sale_id").alias("sales"))


@query("A7_average_money", f"""
SELECT customer_key, {avg2('sum(revenue)', 'count(*)')} AS avg_revenue,
       {avg2('sum(profit)', 'count(*)')} AS avg_profit
FROM fact_sales GROUP BY customer_key
""")
def average_money(spark, sf_dir):
    return per_key(star(spark, sf_dir).sales, "customer_key").select(
        "customer_key",
        average(F.col("revenue"), F.col("n")).alias("avg_revenue"),
        average(F.col("profit"), F.col("n")).alias("avg_profit"),
    )


@query("A8_average_of_counts", f"""
, per_customer AS (SELECT customer_key, count(*) AS orders FROM fact_sales GROUP BY customer_key)
SELECT store_key, {avg2('sum(orders)', 'count(*)')} AS avg_orders
FROM fact_sales JOIN per_customer USING (customer_key) GROUP BY store_key
""")
def average_of_counts(spark, sf_dir):
    """Per store, the mean over its sales of how often the customer bought anywhere.

    Sales are counted per customer and store first, so the join meets counts, not sales.
    """
    sales = star(spark, sf_dir).sales
    pairs = sales.groupBy("customer_key", "store_key").agg(F.count(F.lit(1)).alias("n"))
    orders = sales.groupBy("customer_key").agg(F.count(F.lit(1)).alias("orders"))
    weighted = F.col("n").cast("decimal(19,0)") * F.col("orders")
    return (
        pairs.join(orders, "customer_key")
        .groupBy("store_key")
        .agg(average(F.sum(weighted), F.sum("n")).alias("avg_orders"))
    )


@query("A9_percent_of_sums", f"""
SELECT store_key, {pct2('sum(profit)', 'sum(revenue)')} AS margin,
       {pct2('sum(profit)', '0 * sum(revenue)')} AS no_margin
FROM fact_sales GROUP BY store_key
""")
def percent_of_sums(spark, sf_dir):
    base = F.col("revenue")
    return per_key(star(spark, sf_dir).sales, "store_key").select(
        "store_key",
        percent(F.col("profit"), base).alias("margin"),
        percent(F.col("profit"), base * 0).alias("no_margin"),
    )


@query("A10_conditional_counts", """
SELECT count(*) FILTER (c_mktsegment = 'MACHINERY') AS missing,
       count(*) FILTER (c_acctbal < 0) AS negative,
       (SELECT count(*) FROM customers_source WHERE NOT contains(email, '@')) AS bad_emails
FROM customer
""")
def conditional_counts(spark, sf_dir):
    """All counts in one scan; the address is made as in the customer extract."""
    email = F.concat("c_custkey", F.when(F.col("c_custkey") % 10 == 0, "").otherwise("@"), F.lit("x.test"))
    return table(spark, sf_dir, "customer").agg(
        F.count_if(F.nullif("c_mktsegment", F.lit("MACHINERY")).isNull()).alias("missing"),
        F.count_if(F.col("c_acctbal") < 0).alias("negative"),
        F.count_if(~has_at_sign(email)).alias("bad_emails"),
    )


@query("A11_no_rows", f"""
SELECT count(*) AS sales, CAST(sum(revenue) AS {MONEY}) AS revenue,
       {avg2('sum(revenue)', 'count(*)')} AS avg_revenue
FROM fact_sales WHERE revenue < 0
""")
def no_rows(spark, sf_dir):
    """A whole-table aggregate has one row even when nothing matches."""
    none = star(spark, sf_dir).sales.where("revenue < 0")
    return none.agg(
        F.count(F.lit(1)).alias("sales"),
        sum_money("revenue").alias("revenue"),
        average(sum_money("revenue"), F.count(F.lit(1))).alias("avg_revenue"),
    )


@query("A12_removed_rows", """
SELECT 'sales' AS table_name, (SELECT count(*) FROM sales_source)
       - (SELECT count(*) FROM sales_clean) AS removed
UNION ALL SELECT 'customers', 0 UNION ALL SELECT 'products', 0 UNION ALL SELECT 'stores', 0
""")
def removed_rows(spark, sf_dir):
    stats = build(spark, sf_dir).stats_frame("transform")
    removed = stats.where("metric = 'removed_records'")
    return removed.select("table_name", F.col("value").alias("removed"))


@query("G1_key_with_attributes", """
SELECT product_name, category, count(*) AS sales
FROM fact_sales JOIN dim_product USING (product_key)
GROUP BY product_key, product_name, category
""")
def key_with_attributes(spark, sf_dir):
    whole = star(spark, sf_dir)
    products = whole.product.select("product_key", "product_name", "category")
    return (
        per_key(whole.sales, "product_key")
        .join(products, "product_key")
        .select("product_name", "category", F.col("n").alias("sales"))
    )


@query("G2_attribute", f"""
SELECT supplier, CAST(sum(revenue) AS {MONEY}) AS revenue
FROM fact_sales JOIN dim_product USING (product_key) GROUP BY supplier
""")
def attribute(spark, sf_dir):
    whole = star(spark, sf_dir)
    return (
        per_key(whole.sales, "product_key")
        .join(whole.product.select("product_key", "supplier"), "product_key")
        .groupBy("supplier")
        .agg(total("revenue").alias("revenue"))
    )


@query("G3_whole_table", f"""
SELECT (SELECT count(*) FROM fact_sales) AS sales,
       (SELECT CAST(sum(profit) AS {MONEY}) FROM fact_sales) AS profit,
       (SELECT count(DISTINCT store_key) FROM fact_sales) AS stores
""")
def whole_table(spark, sf_dir):
    return star(spark, sf_dir).sales.agg(
        F.count(F.lit(1)).alias("sales"),
        sum_money("profit").alias("profit"),
        F.count_distinct("store_key").alias("stores"),
    )


@query("G4_nested", """
SELECT orders, count(*) AS customers
FROM (SELECT customer_key, count(*) AS orders FROM fact_sales GROUP BY customer_key)
GROUP BY orders
""")
def nested(spark, sf_dir):
    counts = per_key(star(spark, sf_dir).sales, "customer_key")
    return counts.groupBy(F.col("n").alias("orders")).agg(F.count(F.lit(1)).alias("customers"))

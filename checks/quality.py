"""C: declared constraints as checks. The test tables are clean, so the rules are tightened."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.cleaning import some_nulls
from checks.registry import build, query
from sparkmart.operators import quality
from sparkmart.schemas import FACT_SALES, Rule, fits_money, max_length, not_null
from sparkmart.sources.driver_tables import table
from sparkmart.staging import Staging


@query("C1_not_null", """
SELECT 'not_null:c_name' AS rule, 0 AS violations
UNION ALL SELECT 'not_null:segment', count(*) FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def missing_values(spark, sf_dir):
    rules = not_null("c_name", "segment")
    return quality.count_violations(some_nulls(spark, sf_dir), rules)


@query("C2_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def repeated_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("U2_unique_names", """
SELECT p_name, count(*) AS copies FROM part GROUP BY p_name HAVING count(*) > 1
""")
def unique_names(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "part"), ["p_name"])


@query("C3_foreign_key", """
SELECT product_id, count(*) AS rows FROM sales_clean JOIN products_source USING (product_id)
WHERE category = 'PROMO' GROUP BY product_id
""")
def dangling_keys(spark, sf_dir):
    """Products of one category are taken out of the dimension."""
    run = build(spark, sf_dir)
    products = run.warehouse.table("dim_product").where("category <> 'PROMO'")
    return quality.unmatched_keys(run.cleaned["sales"].rows, "product_id", products)


CHECKS = {
    "C4_quantity": ("check:quantity_positive", "l_quantity - 25 > 0"),
    "C5_unit_price": ("check:unit_price_not_negative", "l_extendedprice - 50000 >= 0"),
    "C6_revenue": ("check:revenue_not_negative", "l_quantity * (l_extendedprice - 9000) >= 0"),
}


def _check(rule):
    return lambda spark, sf_dir: quality.count_violations(table(spark, sf_dir, "lineitem"), [rule])


for _key, (_name, _test) in CHECKS.items():
    query(_key, f"""
    SELECT '{_name}' AS rule, count(*) AS violations FROM lineitem WHERE NOT ({_test})
    """)(_check(Rule(_name, _test)))


@query("C7_max_length", """
SELECT 'max_length:p_name' AS rule, count(*) FILTER (length(p_name) > 10) AS violations FROM part
UNION ALL SELECT 'max_length:p_type', count(*) FILTER (length(p_type) > 7) FROM part
""")
def too_long(spark, sf_dir):
    return quality.count_violations(
        table(spark, sf_dir, "part"), max_length(p_name=10, p_type=7)
    )


@query("C8_money_range", """
SELECT 'fits_money:total' AS rule, count(*) AS violations FROM orders
WHERE round(o_totalprice * 1000, 2) >= 100000000
""")
def money_range(spark, sf_dir):
    totals = (F.col("o_totalprice") * 1000).cast("decimal(18,6)").alias("total")
    orders = table(spark, sf_dir, "orders").select(totals)
    return quality.count_violations(orders, fits_money("total"))


@query("C0_all_fact_rules", """
, checked AS (SELECT quantity - 25 AS quantity, unit_price, revenue - 9000 AS revenue FROM fact_sales)
, counted(rule, violations) AS (
  SELECT 'check:quantity_positive', count(*) FROM checked WHERE quantity <= 0
  UNION ALL SELECT 'check:revenue_not_negative', count(*) FROM checked WHERE revenue < 0
)
SELECT * FROM counted
""")
def all_fact_rules(spark, sf_dir):
    """Every rule of the fact in one pass, over amounts made smaller; broken rules only."""
    sales = build(spark, sf_dir).warehouse.table("fact_sales")
    smaller = sales.withColumns(
        {"quantity": F.col("quantity") - 25, "revenue": F.col("revenue") - 9000}
    )
    return quality.count_violations(smaller, FACT_SALES.rules).where("violations > 0")


@query("C0_quarantine", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice,
       CASE WHEN l_quantity <= 25 AND l_extendedprice < 50000 THEN 'quantity,price'
            WHEN l_quantity <= 25 THEN 'quantity' ELSE 'price' END AS broken
FROM lineitem WHERE l_quantity <= 25 OR l_extendedprice < 50000
""")
def quarantine(spark, sf_dir):
    """The rows set apart, each with the rules it breaks."""
    rules = [Rule("quantity", "l_quantity > 25"), Rule("price", "l_extendedprice >= 50000")]
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice"
    )
    _, bad = quality.enforce(lines, rules, Staging(spark), "lines", quality.QUARANTINE)
    names = F.concat_ws(",", quality.VIOLATIONS).alias("broken")
    return bad.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", names)

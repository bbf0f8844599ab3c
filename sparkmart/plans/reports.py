"""The reports.

Sales are first summed per surrogate key, and only the sums meet the dimension. So the fact is
read once, in the columns at hand, never joined row by row, and what is shuffled is one partial
sum per key and task: a key that holds a third of the sales costs no more than any other. As every
sale has its row in each dimension (the foreign keys are checked at load) the result is that of
joining first.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions.dates import date_key_of
from sparkmart.functions.money import average, percent, sum_money, total


@dataclass(frozen=True)
class Star:
    sales: DataFrame
    product: DataFrame
    customer: DataFrame
    store: DataFrame
    date: DataFrame


def per_key(sales: DataFrame, key: str) -> DataFrame:
    """Count and sums of the sales per key; a report that ignores a sum does not compute it."""
    return sales.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quantity").alias("units"),
        sum_money("revenue").alias("revenue"),
        sum_money("profit").alias("profit"),
        sum_money("unit_price").alias("price"),
    )


def _sum(column: str) -> Column:
    return F.sum(column).cast("bigint")


def largest_first(column: str) -> Column:
    return F.col(column).desc_nulls_first()


def best_keys(sales: DataFrame, key: str, limit: int) -> tuple[DataFrame, list[Column]]:
    """The keys with most revenue and their order; equal revenue in order of the key.

    Only these few rows go on to the dimension and to the averages.
    """
    order = [largest_first("revenue"), F.col(key)]
    return per_key(sales, key).orderBy(*order).limit(limit), order


def top_selling_products(star: Star, limit: int = 10) -> DataFrame:
    """Best products by revenue; equal revenue in order of product."""
    best, order = best_keys(star.sales, "product_key", limit)
    products = star.product.select("product_key", "product_name", "category")
    return (
        best.join(products, "product_key")
        .orderBy(*order)
        .select(
            "product_name",
            "category",
            F.col("units").alias("total_quantity_sold"),
            F.col("revenue").alias("total_revenue"),
            F.col("profit").alias("total_profit"),
            average(F.col("price"), F.col("n")).alias("avg_selling_price"),
        )
    )


def revenue_by_region(star: Star) -> DataFrame:
    stores = star.store.select("store_key", "region")
    return (
        per_key(star.sales, "store_key")
        .join(stores, "store_key")
        .groupBy("region")
        .agg(
            _sum("n").alias("total_transactions"),
            _sum("units").alias("total_units_sold"),
            total("revenue").alias("total_revenue"),
            total("profit").alias("total_profit"),
            average(F.sum("revenue"), F.sum("n")).alias("avg_transaction_value"),
        )
        .orderBy(largest_first("total_revenue"), "region")
    )


def _by_month(star: Star) -> DataFrame:
    days = star.date.select("date_key", "year", "month", "month_name")
    return (
        per_key(star.sales, "date_key")
        .join(days, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            _sum("n").alias("total_transactions"),
            _sum("units").alias("total_quantity"),
            total("revenue").alias("total_revenue"),
            total("profit").alias("total_profit"),
            average(F.sum("revenue"), F.sum("n")).alias("avg_revenue_per_transaction"),
        )
    )


def monthly_sales_trends(star: Star) -> DataFrame:
    return _by_month(star).orderBy(largest_first("year"), largest_first("month"))


def sales_by_store(star: Star) -> DataFrame:
    stores = star.store.select("store_key", "store_name", "city", "state", "region")
    return (
        per_key(star.sales, "store_key")
        .join(stores, "store_key")
        .orderBy(largest_first("revenue"), "store_key")
        .select(
            "store_name",
            "city",
            "state",
            "region",
            F.col("n").alias("total_transactions"),
            F.col("units").alias("total_units_sold"),
            F.col("revenue").alias("total_revenue"),
            F.col("profit").alias("total_profit"),
            average(F.col("revenue"), F.col("n")).alias("avg_transaction_value"),
        )
    )


def customer_purchasing_patterns(star: Star) -> DataFrame:
    """Per segment; both averages give each sale, not each customer, the same weight.

    A customer's order count, averaged over that customer's sales, adds count * count over all
    sales; a customer's average value adds count * (revenue / count), which is the revenue.
    """
    orders = F.col("n").cast("decimal(19,0)")
    segments = star.customer.select("customer_key", "customer_segment")
    return (
        per_key(star.sales, "customer_key")
        .join(segments, "customer_key")
        .groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            _sum("n").alias("total_orders"),
            average(F.sum(orders * orders), F.sum("n")).alias("avg_orders_per_customer"),
            total("revenue").alias("total_revenue"),
            average(F.sum("revenue"), F.sum("n")).alias("avg_order_value"),
        )
        .orderBy(largest_first("total_revenue"), "customer_segment")
    )


def top_customers(star: Star, limit: int = 10) -> DataFrame:
    """Best customers by money spent; equal spending in order of customer."""
    best, order = best_keys(star.sales, "customer_key", limit)
    name = F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    people = star.customer.select(
        "customer_key", name, "email", "city", "state", "customer_segment"
    )
    return (
        best.join(people, "customer_key")
        .orderBy(*order)
        .select(
            "customer_name",
            "email",
            "city",
            "state",
            "customer_segment",
            F.col("n").alias("total_orders"),
            F.col("units").alias("total_items_purchased"),
            F.col("revenue").alias("total_spent"),
            average(F.col("revenue"), F.col("n")).alias("avg_order_value"),
        )
    )


def category_performance(star: Star) -> DataFrame:
    """Per category; products without sales do not count."""
    products = star.product.select("product_key", "category")
    return (
        per_key(star.sales, "product_key")
        .join(products, "product_key")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _sum("n").alias("total_sales"),
            _sum("units").alias("total_quantity_sold"),
            total("revenue").alias("total_revenue"),
            total("profit").alias("total_profit"),
            average(F.sum("profit"), F.sum("n")).alias("avg_profit_per_sale"),
            percent(total("profit"), total("revenue")).alias("profit_margin_pct"),
        )
        .orderBy(largest_first("total_revenue"), "category")
    )


def since(sales: DataFrame, first: dt.date) -> DataFrame:
    """Sales from a day on. The month bound lets Spark skip whole partitions of the fact."""
    key = date_key_of(first)
    recent = sales.where(F.col("date_key") >= key)
    if "date_month" in sales.columns:
        recent = recent.where(F.col("date_month") >= key // 100)
    return recent


def daily_sales_summary(star: Star, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """The last days before as_of and what comes after; days without sales do not appear."""
    first = (as_of or dt.date.today()) - dt.timedelta(days=days)
    calendar = star.date.where(F.col("full_date") >= first)
    return (
        per_key(since(star.sales, first), "date_key")
        .join(calendar.select("date_key", "full_date", "day_name"), "date_key")
        .orderBy(largest_first("full_date"))
        .select(
            "full_date",
            "day_name",
            F.col("n").alias("transactions"),
            F.col("units").alias("units_sold"),
            "revenue",
            "profit",
        )
    )


def distinct_keys(sales: DataFrame, key: str) -> Column:
    """How many different keys occur, as a scalar subquery over that one column."""
    return sales.select(key).distinct().agg(F.count(F.lit(1))).scalar()


def executive_summary(star: Star) -> DataFrame:
    """One row, also for an empty fact: counts 0, sums NULL.

    Two distinct counts beside the sums would make Spark send every row through the aggregate
    three times. Each distinct count reads its own column instead; no column is read twice.
    """
    sums = star.sales.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        sum_money("revenue").alias("total_revenue"),
        sum_money("profit").alias("total_profit"),
        F.sum("quantity").alias("total_units_sold"),
    )
    revenue, profit = F.col("total_revenue"), F.col("total_profit")
    return sums.select(
        "total_transactions",
        "total_revenue",
        "total_profit",
        "total_units_sold",
        distinct_keys(star.sales, "customer_key").alias("unique_customers"),
        distinct_keys(star.sales, "product_key").alias("products_sold"),
        average(revenue, F.col("total_transactions")).alias("avg_transaction_value"),
        percent(profit, revenue).alias("overall_profit_margin"),
    )


def full_report(star: Star, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """All nine reports by name (fixed values); each runs when its result is asked for."""
    return {
        "executive_summary": executive_summary(star),
        "top_products": top_selling_products(star, 10),
        "revenue_by_region": revenue_by_region(star),
        "monthly_trends": monthly_sales_trends(star),
        "store_performance": sales_by_store(star),
        "customer_patterns": customer_purchasing_patterns(star),
        "top_customers": top_customers(star, 10),
        "category_performance": category_performance(star),
        "daily_summary": daily_sales_summary(star, 30, as_of),
    }


def sales_summary(star: Star) -> DataFrame:
    """One row per sale with the attributes of all four dimensions."""
    customers = star.customer.select("customer_key", F.col("city").alias("customer_city"))
    return (
        star.sales.join(star.date.select("date_key", "full_date", "month_name", "year"), "date_key")
        .join(star.product.select("product_key", "product_name", "category"), "product_key")
        .join(customers, "customer_key")
        .join(star.store.select("store_key", "store_name", "region"), "store_key")
        .select(
            "full_date", "month_name", "year", "product_name", "category", "customer_city",
            "store_name", "region", "quantity", "revenue", "profit",
        )
    )


def monthly_revenue(star: Star) -> DataFrame:
    """As the monthly trends; being a view, it leaves the order to its reader."""
    return _by_month(star)


def revenue_per_product_name(star: Star) -> DataFrame:
    """The ten names with most revenue; products that share a name count as one."""
    return (
        per_key(star.sales, "product_key")
        .join(star.product.select("product_key", "product_name"), "product_key")
        .groupBy("product_name")
        .agg(total("revenue").alias("total_revenue"))
        .orderBy(largest_first("total_revenue"), "product_name")
        .limit(10)
    )


def revenue_per_region(star: Star) -> DataFrame:
    return revenue_by_region(star).select("region", "total_revenue")


def revenue_per_month(star: Star) -> DataFrame:
    days = star.date.select("date_key", "year", "month")
    return (
        per_key(star.sales, "date_key")
        .join(days, "date_key")
        .groupBy("year", "month")
        .agg(total("revenue").alias("total_revenue"))
        .orderBy(largest_first("year"), largest_first("month"))
    )


def customer_insights(star: Star) -> DataFrame:
    segments = star.customer.select("customer_key", "customer_segment")
    return (
        per_key(star.sales, "customer_key")
        .join(segments, "customer_key")
        .groupBy("customer_segment")
        .agg(F.count(F.lit(1)).alias("customer_count"), total("revenue").alias("total_revenue"))
    )


NAMED_QUERIES = {
    "top_products": revenue_per_product_name,
    "revenue_by_region": revenue_per_region,
    "monthly_trends": revenue_per_month,
    "customer_insights": customer_insights,
}

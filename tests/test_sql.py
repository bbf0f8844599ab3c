"""SQL text over the warehouse, next to the reports that say the same."""

from __future__ import annotations

import pytest

from sparkmart.plans import reports
from sparkmart.sources.driver_tables import AS_OF
from sparkmart.sources.sql import run_query


@pytest.fixture
def star(small_build):
    small_build.warehouse.register_views()
    return small_build.warehouse.star()


def test_limit_parameter(spark, star):
    text = """
        SELECT product_name, category, sum(revenue) AS total_revenue
        FROM fact_sales JOIN dim_product USING (product_key)
        GROUP BY product_key, product_name, category
        ORDER BY total_revenue DESC, product_key LIMIT %(limit)s
    """
    rows = [tuple(r) for r in run_query(spark, text, {"limit": 7}).collect()]
    best = reports.top_selling_products(star, 7)
    assert rows == [tuple(r) for r in best.select("product_name", "category", "total_revenue").collect()]


def test_interval_parameter(spark, star):
    text = """
        SELECT full_date, count(*) AS transactions
        FROM fact_sales JOIN dim_date USING (date_key)
        WHERE full_date >= :today - INTERVAL '%(days)s days'
        GROUP BY full_date ORDER BY full_date DESC
    """
    rows = [tuple(r) for r in run_query(spark, text, {"days": 30, "today": AS_OF}).collect()]
    daily = reports.daily_sales_summary(star, 30, AS_OF)
    assert rows == [tuple(r) for r in daily.select("full_date", "transactions").collect()]
    with pytest.raises(ValueError):
        run_query(spark, text, {"days": "1' OR '1", "today": AS_OF})


def test_scalar_subqueries(spark, star):
    text = """
        SELECT (SELECT count(*) FROM fact_sales) AS sales,
               (SELECT count(DISTINCT customer_key) FROM fact_sales) AS customers,
               (SELECT sum(profit) FROM fact_sales) AS profit
    """
    row = run_query(spark, text).first()
    whole = reports.executive_summary(star).first()
    assert tuple(row) == (whole.total_transactions, whole.unique_customers, whole.total_profit)


def test_views(spark, star):
    text = "SELECT count(*) AS n FROM vw_sales_summary WHERE region = %(region)s"
    asia = reports.revenue_by_region(star).where("region = 'ASIA'").first()
    assert run_query(spark, text, {"region": "ASIA"}).first().n == asia.total_transactions
    months = run_query(spark, "SELECT * FROM vw_monthly_revenue ORDER BY year DESC, month DESC")
    assert months.collect() == reports.monthly_sales_trends(star).collect()


def test_errors_are_raised(spark):
    with pytest.raises(Exception):
        run_query(spark, "SELECT nothing FROM nowhere")

"""Time the star build and the headline queries; print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. The build time stands
on its own; the reports read the built star, as reports over a warehouse do. Every query runs to
its last row.
"""

from __future__ import annotations

import json
import os
import time

from checks import QUERIES
from checks.registry import build
from sparkmart.session import local_session

HEADLINE = [
    "R1_top_selling_products", "R2_revenue_by_region", "R3_monthly_sales_trends",
    "R4_sales_by_store", "R5_customer_purchasing_patterns", "R6_top_customers",
    "R7_category_performance", "R8_daily_sales_summary", "R9_executive_summary",
    "V1_sales_summary_view", "V2_monthly_revenue_view", "N1_top_products",
    "N2_revenue_by_region", "N3_monthly_trends", "N4_customer_insights",
    "U1_keep_first", "Q3_non_negative", "J8_customer_figures", "K7_dense_keys", "B6_fact_rows",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any figure
    seconds = {"star_build": timed(lambda: build(spark, sf_dir))}
    for name in HEADLINE:
        query = QUERIES[name]
        seconds[name] = timed(
            lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

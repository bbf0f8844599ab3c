"""Plans that must hold when the data grows: pruning, early sums, and hot keys spread over tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.cleaning import keep_first
from sparkmart.operators.joins import lookup, with_group_figures
from sparkmart.operators.keys import POSITION, number_rows, stage_in_order
from sparkmart.plans import facts, reports
from sparkmart.schemas import DIM_STORE
from sparkmart.session import cluster_settings
from sparkmart.sources.driver_tables import AS_OF

ROWS = 200_000


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it ran, after all runtime changes."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.fixture
def small_limits(spark):
    """Limits at which a few hundred kilobytes are a large partition; nothing is broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot_sales(spark, staging):
    """A third of all sales have the customer 7."""
    customer = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("customer_id")
    rows = spark.range(0, ROWS, 1, 8).select("id", customer, (F.col("id") * 31).alias("amount"))
    staged, _ = staging.write(rows, "hot_sales")
    return staged


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_of_a_lookup_is_split(spark, staging, small_limits, hot_sales, how):
    customers, _ = staging.write(
        spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") + 1).alias("customer_key")),
        "customers",
    )
    joined = lookup(hot_sales, customers, "customer_id", ["customer_key"], how=how)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == ROWS
    assert joined.where("customer_key <> customer_id + 1").count() == 0


def test_hot_group_keeps_all_rows_and_is_split(spark, staging, small_limits, hot_sales):
    joined = with_group_figures(hot_sales, ["customer_id"], staging, "groups", n=F.count("*"))
    assert "skew=true" in final_plan(joined)
    counts = joined.groupBy("customer_id").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    assert counts.where("rows <> n").count() == 0
    assert joined.count() == ROWS


def test_hot_day_is_split_by_the_numbering(spark, staging, small_limits):
    day = F.when(F.col("id") % 3 == 0, 20260310).otherwise(20250000 + F.col("id") % 300)
    rows = spark.range(0, ROWS, 1, 8).select(day.alias("date_key"), F.col("id").alias("order_id"))
    staged, _ = stage_in_order(rows, ["date_key", "order_id"], staging, "fact")
    sizes = staged.groupBy(F.shiftright(POSITION, 33)).count().collect()
    assert max(s["count"] for s in sizes) < ROWS / 6
    numbered = number_rows(staged, "sale_id")
    ends = numbered.agg(F.min("sale_id"), F.max("sale_id"), F.count_distinct("sale_id")).first()
    assert tuple(ends) == (1, ROWS, ROWS)
    # Only the list of partition starts is shuffled, never the rows.
    exchanges = re.findall(r"\bExchange \w+", plan_of(numbered))
    assert "order_id" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan_of(numbered)))
    assert len(exchanges) <= 2


def test_copies_of_a_hot_key_meet_one_row_per_task(spark, staging):
    """A third of the rows are copies of one order; at most one per map task is shuffled."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("order_id")
    rows = spark.range(0, ROWS, 1, 8).select(key, F.col("id").alias("position"))
    first = keep_first(rows, ["order_id"], ["position"])
    assert first.count() == ROWS - len(range(0, ROWS, 3)) + 1
    assert first.where("order_id = -1").first().position == 0
    plan = plan_of(first)
    below_exchange = plan[plan.index("Exchange hashpartitioning(order_id"):]
    assert "partial_min(struct(position" in below_exchange


REPORTS = {
    "top_selling_products": reports.top_selling_products,
    "revenue_by_region": reports.revenue_by_region,
    "monthly_sales_trends": reports.monthly_sales_trends,
    "sales_by_store": reports.sales_by_store,
    "customer_purchasing_patterns": reports.customer_purchasing_patterns,
    "top_customers": reports.top_customers,
    "category_performance": reports.category_performance,
    "daily_sales_summary": lambda star: reports.daily_sales_summary(star, 30, AS_OF),
    **reports.NAMED_QUERIES,
}


@pytest.mark.parametrize("name", REPORTS)
def test_sales_are_summed_before_any_join(small_build, name):
    """Under the scan of the fact stand only projections, filters and the partial sum."""
    plan = plan_of(REPORTS[name](small_build.warehouse.star()))
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "fact_sales" in line and "FileScan" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            assert "Join" not in line
            if "HashAggregate" in line:
                assert "partial_" in line
                break
    else:
        pytest.fail("no partial sum above the scan")


def test_scans_read_only_what_they_need(small_build):
    star = small_build.warehouse.star()
    plan = plan_of(reports.revenue_per_region(star))
    read = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<store_key:bigint,revenue:decimal(10,2)>" in read
    assert "struct<store_key:bigint,region:string>" in read


def test_recent_sales_skip_partitions(small_build):
    plan = plan_of(reports.daily_sales_summary(small_build.warehouse.star(), 30, AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*date_month[^\]]*>= 200107", plan)
    assert "GreaterThanOrEqual(date_key,20010703)" in plan


def test_no_python_in_any_plan(small_build):
    star = small_build.warehouse.star()
    for report in reports.full_report(star, AS_OF).values():
        assert "Python" not in plan_of(report)


def test_settings_grow_with_the_data():
    assert cluster_settings(0)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_settings(1024**4)["spark.sql.shuffle.partitions"] == "2048"
    assert cluster_settings(100 * 1024**4)["spark.sql.shuffle.partitions"] == "204800"
    assert cluster_settings(100 * 1024**4 + 1)["spark.sql.shuffle.partitions"] == "204801"


def test_fact_input_is_dealt_by_day_and_order(spark, staging, small_limits):
    """A hot day with a third of the sales falls into many tasks; ids rise with (date, order)."""
    day = F.when(F.col("id") % 3 == 0, 69).otherwise(F.col("id") % 300).cast("int")
    sales, _ = staging.write(
        spark.range(0, ROWS, 1, 8).select(F.col("id").alias("order_id"), F.date_add(F.lit("2025-01-01"), day).alias("order_date")),
        "sales",
    )
    dates = sales.select(F.col("order_date").alias("full_date"), F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key")).distinct()
    inputs = sales.select("order_id", F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key"))
    ordered, _ = staging.write(facts.in_order(inputs, sales, facts.Dimensions(None, None, None, dates)), "ordered")
    sizes = ordered.groupBy(F.shiftright(F.col("sale_id") - 1, 33)).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 1.2 * ROWS / 16
    rows = [tuple(r) for r in ordered.orderBy("sale_id").collect()]
    assert len({r[0] for r in rows}) == ROWS
    assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (r[1], r[0]))


def test_sales_are_read_once_for_all_lookup_figures(small_build):
    warehouse = small_build.warehouse
    sales = warehouse.star().sales
    keyed = sales.select(
        F.col("product_key").alias("product_id"), F.col("customer_key").alias("customer_id"),
        F.col("store_key").alias("store_id"), F.col("created_at").alias("order_date"),
    )
    tables = [warehouse.table(t) for t in ("dim_product", "dim_customer", "dim_store", "dim_date")]
    plan = plan_of(facts.lookup_figures(keyed, facts.Dimensions(*tables)))
    assert len([line for line in plan.splitlines() if "FileScan" in line and "fact_sales" in line]) == 1


@pytest.fixture
def shops(spark, warehouse):
    """A warehouse with 2,000 stores, and a frame of stores from a key on."""
    warehouse.create_database()
    warehouse.create_schema()

    def stores(rows, key):
        texts = [F.lit("x").alias(c) for c in ("store_name", "city", "state", "region", "manager_name")]
        day = F.lit("2020-01-01").cast("date").alias("opening_date")
        return rows.select(key.alias("store_key"), (key + 10**6).alias("store_id"), *texts, day)

    warehouse.append(stores(spark.range(2000), F.col("id")), DIM_STORE)
    return warehouse, stores


def test_keys_are_checked_without_whole_rows(spark, shops, monkeypatch):
    """No window and no whole row in a shuffle: only keys are counted and looked up."""
    warehouse, stores = shops
    plans, write = [], warehouse.staging.write

    def noting(df, name, *args, **kwargs):
        plans.append(plan_of(df))
        return write(df, name, *args, **kwargs)

    monkeypatch.setattr(warehouse.staging, "write", noting)
    assert warehouse.append(stores(spark.range(5000, 6000), F.col("id")), DIM_STORE) == 0
    assert len(plans) == 3 and not any("Window" in p for p in plans)
    assert not any("store_name" in line for p in plans for line in p.splitlines() if "Exchange" in line)
    assert warehouse.count(DIM_STORE) == 3000


def test_only_the_range_of_new_keys_is_read(shops):
    warehouse, _ = shops
    scan = plan_of(warehouse.existing_keys(DIM_STORE, "store_key", 5000, 6000))
    assert "GreaterThanOrEqual(store_key,5000)" in scan and "LessThanOrEqual(store_key,6000)" in scan
    assert "ReadSchema: struct<store_key:bigint>" in scan


def test_a_hot_repeated_key_is_split(spark, shops, small_limits):
    """A third of 200,000 new stores have the key 7,000, every tenth of the others one that is there."""
    warehouse, stores = shops
    key = F.when(F.col("id") % 3 == 0, 7000).when(F.col("id") % 10 == 1, F.col("id") % 2000).otherwise(F.col("id") + 10_000)
    rows = stores(spark.range(0, ROWS, 1, 8), key).withColumn("store_id", F.monotonically_increasing_id() + 10**9)
    staged, marked = warehouse.checked(rows, DIM_STORE, against=True)
    assert "skew=true" in final_plan(marked)
    bad = spark.range(ROWS).where("id % 3 = 0 OR id % 10 = 1").count()
    assert marked.where(F.size("_violations") > 0).count() == bad and marked.count() == ROWS


def test_a_range_that_meets_no_segment(spark, shops):
    """Keys without a range, all null, are checked too."""
    warehouse, stores = shops
    nothing = stores(spark.range(0), F.col("id"))
    assert warehouse.append(nothing, DIM_STORE) == 0 and warehouse.count(DIM_STORE) == 2000

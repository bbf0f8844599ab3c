"""Tasks stay small whatever number of shuffle partitions the session has."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from checks import sources as source_checks
from sparkmart import session
from sparkmart.operators import cleaning, keys
from sparkmart.plans import facts, transforms
from sparkmart.plans.build import StarBuild
from sparkmart.plans.warehouse import Warehouse, with_load_columns
from sparkmart.schemas import DIM_STORE
from sparkmart.session import input_bytes, sized
from sparkmart.sources import driver_tables
from sparkmart.staging import Staging

PARTITIONS = "spark.sql.shuffle.partitions"
PIECE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT = "spark.sql.files.maxPartitionBytes"
DAY = dt.datetime(1997, 5, 1)


@pytest.fixture
def small_sorts(monkeypatch):
    monkeypatch.setattr(session, "BYTES_PER_SORT", 1000)


@pytest.fixture
def uncoalesced(spark):
    """Partitions of less than a megabyte stay apart."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    yield
    spark.conf.unset(setting)


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of the test schema: 200 orders of three lines, every fifth line twice, some values null."""
    folder = str(tmp_path / "tables")

    def write(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    write("region", [(0, "ASIA"), (1, "EUROPE")], "r_regionkey BIGINT, r_name STRING")
    write("nation", [(0, "JAPAN", 0), (1, "FRANCE", 1)], "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT")
    write("supplier", [(i, f"S{i}", i % 2) for i in range(10)], "s_suppkey BIGINT, s_name STRING, s_nationkey BIGINT")
    write("part", [(i, f"P{i}", "PROMO", 2.5, "B") for i in range(20)],
          "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE, p_brand STRING")
    write("customer", [(i, f"C#{i}", i % 2, "AUTO") for i in range(30)],
          "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT, c_mktsegment STRING")
    write("orders", [(i, i % 30, DAY + dt.timedelta(days=i % 90)) for i in range(200)],
          "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP")
    lines = [
        (o, n, (o + n) % 20 if (o + n) % 17 else None, o % 10, float(1 + copy + o % 7) + 0.5,
         100.25 - copy, 0.1 * copy, 0.0, "N", "O", DAY + dt.timedelta(days=copy * (n - 2)))
        for o in range(200) for n in (1, 2, 3) for copy in range(2 if (o + n) % 5 == 0 else 1)
    ]
    write("lineitem", lines, "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE,"
          " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
          " l_shipdate TIMESTAMP")
    return folder


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partitions_follow_the_input_and_come_back(spark, staging, small_sorts):
    stored, _ = staging.write(spark.range(5000), "stored")
    before = {s: spark.conf.get(s) for s in (PARTITIONS, PIECE, SPLIT)}
    expected = -(-input_bytes(stored) // 1000)
    assert expected > 10
    with sized(spark, stored):
        assert spark.conf.get(PARTITIONS) == str(expected)
        assert (spark.conf.get(PIECE), spark.conf.get(SPLIT)) == ("2000", "2000")
    assert {s: spark.conf.get(s) for s in before} == before
    with pytest.raises(ZeroDivisionError), sized(spark, stored):
        1 / 0
    assert {s: spark.conf.get(s) for s in before} == before


def test_small_input_keeps_the_partitions_of_the_session(spark, staging):
    stored, _ = staging.write(spark.range(10), "stored")
    with sized(spark, stored, spark.range(3)):
        assert spark.conf.get(PARTITIONS) == "2"


def test_steps_in_other_threads_share_the_settings_of_the_first(spark, staging, small_sorts):
    stored, _ = staging.write(spark.range(5000), "stored")
    before, entered, leave = spark.conf.get(PARTITIONS), threading.Event(), threading.Event()

    def step():
        with sized(spark, spark.range(1)):
            entered.set()
            leave.wait(60)

    thread = threading.Thread(target=step)
    with sized(spark, stored):
        inside = spark.conf.get(PARTITIONS)
        thread.start()
        assert entered.wait(60)
    assert spark.conf.get(PARTITIONS) == inside != before  # the other step is not over
    leave.set()
    thread.join()
    assert spark.conf.get(PARTITIONS) == before


def test_a_build_over_a_larger_input_has_more_tasks(spark, tables, tmp_path, small_sorts, uncoalesced):
    def built(name, sort):
        session.BYTES_PER_SORT = sort
        staging = Staging(spark, str(tmp_path / name))
        warehouse = Warehouse(spark, f"mart_{name}", location=staging.path("warehouse"))
        run = StarBuild(driver_tables.extracts(spark, tables), warehouse, driver_tables.AS_OF,
                        driver_tables.DATE_RANGE, staging=staging, keep_staged=True)
        return run.run()

    many, few = built("many", 1000), built("few", 8 * 1024**2)
    files = [len(run.cleaned["sales"].staged.inputFiles()) for run in (many, few)]
    assert files[1] <= 2 < 6 < files[0]  # the session has two shuffle partitions
    assert spark.conf.get(PARTITIONS) == "2"
    assert many.stats == few.stats
    for table in ("dim_product", "dim_customer", "dim_store", "dim_date"):
        assert rows_of(many.warehouse.table(table)) == rows_of(few.warehouse.table(table))
    facts_of = [run.warehouse.table("fact_sales").drop("created_at") for run in (many, few)]
    assert rows_of(facts_of[0].drop("sale_id")) == rows_of(facts_of[1].drop("sale_id"))


def test_sales_travel_without_what_follows_from_their_order(spark, tables, staging, monkeypatch):
    extract = driver_tables.sales(spark, tables)
    whole = cleaning.keep_first(extract.rows, ["order_id"], extract.order_by).select(*extract.source.columns)
    expected = rows_of(whole.where(cleaning.present(extract.source.required)))
    carried, keep_first = [], cleaning.keep_first
    monkeypatch.setattr(cleaning, "keep_first", lambda df, *a, **k: (carried.append(df.columns), keep_first(df, *a, **k))[1])
    cleaned = transforms.clean(extract, staging)
    assert rows_of(cleaned.staged) == expected
    assert not {"product_id", "store_id", "quantity", "price"} & set(carried[0])


def test_the_fact_is_sorted_for_its_partitions(spark, staging):
    rows = spark.range(1000).select(
        F.col("id").alias("order_id"), F.date_add(F.lit("2025-01-01"), (F.col("id") % 90).cast("int")).alias("order_date"))
    sales, _ = staging.write(rows, "sales")
    key = F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key")
    dates = sales.select(F.col("order_date").alias("full_date"), key).distinct()
    inputs = sales.select("order_id", key)
    ordered = with_load_columns(facts.in_order(inputs, sales, facts.Dimensions(None, None, None, dates)))
    sorts = [line for line in ordered._jdf.queryExecution().sparkPlan().toString().splitlines() if "Sort [" in line]
    assert "Sort [date_month#" in sorts[0] and "date_key#" in sorts[0] and "order_id#" in sorts[0]
    assert ordered.where("date_month <> floor(date_key / 100)").count() == 0
    assert ordered.count() == 1000


@pytest.fixture
def partitions_of_writes(spark, monkeypatch):
    seen, write = [], Warehouse.write_version

    def write_version(self, *args, **kwargs):
        seen.append(int(spark.conf.get(PARTITIONS)))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "write_version", write_version)
    return seen


@pytest.mark.parametrize("step", ["append", "refresh", "compact"])
def test_changes_of_a_table_are_sized(spark, staging, warehouse, small_sorts, partitions_of_writes, step):
    stores, _ = staging.write(
        spark.range(1, 1001).select(
            F.col("id").alias("store_key"), F.col("id").alias("store_id"), F.concat(F.lit("s"), "id").alias("store_name"),
            F.lit("c").alias("city"), F.lit("t").alias("state"), F.lit("r").alias("region"),
            F.lit(None).cast("string").alias("manager_name"), F.lit(dt.date(2020, 1, 1)).alias("opening_date"),
        ), "stores")
    warehouse.create_database()
    warehouse.create_schema()
    if step == "refresh":
        warehouse.refresh(stores, DIM_STORE)
    else:
        warehouse.append(stores.where("store_id <= 500"), DIM_STORE)
        warehouse.append(stores.where("store_id > 500"), DIM_STORE)
    if step == "compact":
        partitions_of_writes.clear()
        warehouse.compact(DIM_STORE)
    assert min(partitions_of_writes) > 4
    assert spark.conf.get(PARTITIONS) == "2"
    assert rows_of(warehouse.table(DIM_STORE).select("store_key")) == rows_of(stores.select("store_key"))


def test_extracts_are_written_in_tasks_that_follow_their_size(spark, tables, small_sorts, monkeypatch):
    seen, write = {}, source_checks.write_csv

    def write_csv(df, path):
        seen[path.rsplit("/", 1)[-1]] = int(spark.conf.get(PARTITIONS))
        write(df, path)

    monkeypatch.setattr(source_checks, "write_csv", write_csv)
    stats = {r["source"]: r["records"] for r in source_checks.scan_stats(spark, tables).collect()}
    assert seen["sales.csv"] > 4 and spark.conf.get(PARTITIONS) == "2"
    lines = spark.read.parquet(f"{tables}/lineitem.parquet").count()
    assert stats == {"sales": lines, "customers": 30, "products": 20, "stores": 10}


def test_numbering_is_sized(spark, staging, small_sorts, monkeypatch):
    seen, stage = [], keys.stage_in_order

    def stage_in_order(df, *args, **kwargs):
        seen.append(int(spark.conf.get(PARTITIONS)))
        return stage(df, *args, **kwargs)

    monkeypatch.setattr(keys, "stage_in_order", stage_in_order)
    stored, _ = staging.write(spark.range(5000), "stored")
    numbered = keys.dense_keys(stored, "n", ["id"], staging, "numbered")
    assert seen[0] > 10 and spark.conf.get(PARTITIONS) == "2"
    assert numbered.where("n <> id + 1").count() == 0 and numbered.count() == 5000

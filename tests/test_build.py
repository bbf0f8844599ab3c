"""Loading: keys, rounding, windows, constraints, quarantine and idempotence."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from checks.registry import build
from conftest import TABLES
from sparkmart.operators import quality
from sparkmart.operators.joins import with_group_figures
from sparkmart.operators.keys import dense_keys
from sparkmart.plans import reports
from sparkmart.plans.build import StarBuild
from sparkmart.plans.calendar import date_dimension
from sparkmart.plans.warehouse import ConcurrentChange
from sparkmart.schemas import DIM_DATE, DIM_STORE, FACT_SALES, TABLES as TABLES_OF_STAR, Rule
from sparkmart.sources import driver_tables
from sparkmart.sources.extracts import extract_all
from sparkmart.staging import Staging

DAY = dt.date(2026, 3, 10)
CUSTOMER = (1, "A", "B", "a@b", None, "city", "ST", dt.date(2026, 1, 1))
PRODUCT = (1, "lamp", "light", D("0.994"), "s")
STORE = (1, "shop", "city", "ST", "West", None, dt.date(2020, 1, 1))


def sale(order_id, product=1, customer=1, store=1, quantity=1, price="1.006", day=DAY):
    return (order_id, product, customer, store, quantity, D(price), day)


@pytest.fixture
def run(extract, warehouse, spark, tmp_path):
    def go(sales, products=(PRODUCT,), customers=(CUSTOMER,), stores=(STORE,), **options):
        sources = {"sales": sales, "products": products, "customers": customers, "stores": stores}
        extracts = {name: extract(name, rows) for name, rows in sources.items()}
        staging = Staging(spark, str(tmp_path / "staging"))
        return StarBuild(extracts, warehouse, DAY, staging=staging, **options).run()

    return go


def test_each_measure_is_rounded_on_its_own(run):
    star = run([sale(1)]).warehouse.star()
    row = star.sales.first()
    assert (row.unit_price, row.revenue, row.cost, row.profit) == (
        D("1.01"), D("1.01"), D("0.99"), D("0.01"),
    )
    assert row.sale_id == 1 and row.created_at is not None


def test_csv_and_table_extracts_give_the_same_star(spark, small_build):
    """One star is built from CSV files, the other from the tables they were written from."""
    other = build(spark, TABLES).warehouse
    for table in TABLES_OF_STAR:
        mine = small_build.warehouse.table(table).drop("created_at")
        theirs = other.table(table).drop("created_at")
        assert mine.exceptAll(theirs).count() == 0 and theirs.exceptAll(mine).count() == 0


def test_rerun_gives_identical_tables(spark, small_build, csv_folder, tmp_path):
    before = {t: small_build.warehouse.table(t).drop("created_at").collect() for t in TABLES_OF_STAR}
    again = StarBuild(
        extract_all(spark, csv_folder),
        small_build.warehouse,
        driver_tables.AS_OF,
        driver_tables.DATE_RANGE,
        staging=Staging(spark, str(tmp_path)),
    ).run()
    assert again.stats == small_build.stats
    for table, rows in before.items():
        now = small_build.warehouse.table(table).drop("created_at").collect()
        assert set(now) == set(rows) and len(now) == len(rows)


def test_stats_and_summary(small_build):
    sales = small_build.stats["transform"]["sales"]
    assert sales["removed_records"] == sales["input_records"] - sales["output_records"] > 0
    assert small_build.stats["load"]["fact_sales"]["records_inserted"] == sales["output_records"]
    assert small_build.validation_errors == [] and small_build.validation_frame().count() == 0
    run = small_build.summary_frame().where("stage = 'run'").collect()
    values = {r.metric: r.value for r in run}
    assert values["status"] == "SUCCESS" and int(values["duration_seconds"]) >= 0


def test_views_agree_with_summary(small_build):
    star = small_build.warehouse.star()
    whole = reports.executive_summary(star).first()
    view = reports.sales_summary(star).agg(F.sum("revenue"), F.count("*")).first()
    assert tuple(view) == (whole.total_revenue, whole.total_transactions)
    months = reports.monthly_revenue(star).agg(F.sum("total_profit")).first()
    assert months[0] == whole.total_profit


def test_empty_fact(run):
    star = run([sale(1, day=DAY - dt.timedelta(days=400))]).warehouse.star()
    assert tuple(reports.executive_summary(star).first()) == (0, None, None, None, 0, 0, None, None)
    for name, report in reports.full_report(star, DAY).items():
        assert report.count() == (1 if name == "executive_summary" else 0)


def test_window_bounds_and_unresolved(run):
    days = [DAY + dt.timedelta(days=d) for d in (-121, -120, 30, 31)]
    sales = [sale(i, day=d) for i, d in enumerate(days)]
    sales += [sale(10, customer=7), sale(11, store=7), sale(12, customer=7, store=7)]
    build = run(sales)
    keys = [r.date_key for r in build.warehouse.table("fact_sales").collect()]
    assert sorted(keys) == [20251110, 20260409]
    load = build.stats["load"]["fact_sales"]
    assert load["records_source"] == 7 and load["records_inserted"] == 2
    assert load["unresolved_order_date"] == 2
    assert load["unresolved_customer_id"] == 2 and load["unresolved_store_id"] == 2
    assert load["unresolved_product_id"] == 0


def test_zero_quantity_fails_and_leaves_the_tables(run, warehouse):
    run([sale(1)])
    before = {t: warehouse.table(t).collect() for t in TABLES_OF_STAR}
    more_days = (DAY, DAY + dt.timedelta(days=400))
    more_stores = [STORE, (2, *STORE[1:])]
    bad_sales = [sale(1), sale(2, quantity=0), sale(3, quantity=0)]
    with pytest.raises(quality.ConstraintViolation) as error:
        run(bad_sales, stores=more_stores, date_range=more_days)
    assert error.value.counts == {"check:quantity_positive": 2}
    assert {t: warehouse.table(t).collect() for t in TABLES_OF_STAR} == before


def test_failed_run_keeps_its_status(extract, warehouse, spark, tmp_path):
    extracts = {
        "sales": extract("sales", [sale(1, quantity=0)]),
        "products": extract("products", [PRODUCT]),
        "customers": extract("customers", [CUSTOMER]),
        "stores": extract("stores", [STORE]),
    }
    build = StarBuild(extracts, warehouse, DAY, staging=Staging(spark, str(tmp_path / "s")))
    assert build.status == "NOT_STARTED"
    with pytest.raises(quality.ConstraintViolation):
        build.run()
    assert build.status == "FAILED" and build.end_time is not None


def test_quarantine(run, warehouse):
    build = run(
        [sale(1), sale(2, quantity=0), sale(3, product=2)],
        products=[PRODUCT, (2, "cup", "kitchen", D(1), None)],
        on_violation=quality.QUARANTINE,
    )
    assert [r.sale_id for r in warehouse.table("fact_sales").collect()] == [1]
    rejected = warehouse.table("fact_sales_rejected").first()
    assert (rejected.order_id, rejected[quality.VIOLATIONS]) == (2, ["check:quantity_positive"])
    assert warehouse.table("dim_product_rejected").first()[quality.VIOLATIONS] == ["not_null:supplier"]
    # The product without supplier has a cost, so its sale is clean; it has no key to load with.
    assert build.stats["transform"]["sales"]["output_records"] == 3
    assert build.stats["load"]["fact_sales_rejected"] == {"records_inserted": 1}


def test_missing_unit_cost_breaks_the_product_table(run):
    with pytest.raises(quality.ConstraintViolation) as error:
        run([sale(1)], products=[(1, "lamp", "light", None, "s")])
    assert error.value.counts == {"not_null:unit_cost": 1}


def test_amount_out_of_range_is_counted_not_raised_in_the_cast(run):
    with pytest.raises(quality.ConstraintViolation) as error:
        run([sale(1, quantity=2, price="99999999")])
    assert "fits_money:revenue" in error.value.counts


def test_existing_days_stay(run, warehouse):
    run([sale(1)])
    before = warehouse.count(DIM_DATE)
    more = date_dimension(warehouse.spark, DAY, dt.date(2026, 4, 15)).withColumn("day_name", F.lit("new"))
    assert warehouse.add_dates(more) == before + 6
    names = {r.full_date: r.day_name for r in warehouse.table(DIM_DATE).collect()}
    assert names[DAY] == "Tuesday  " and names[dt.date(2026, 4, 15)] == "new"


def test_schema_creation_empties_everything(run, warehouse):
    run([sale(1)])
    warehouse.create_schema()
    assert {warehouse.count(t) for t in TABLES_OF_STAR.values()} == {0}
    assert warehouse.table(FACT_SALES).columns == list(FACT_SALES.columns)


def test_refresh_ignores_a_dynamic_session(run, warehouse):
    """A session that replaces only touched partitions must not keep old months."""
    spark = warehouse.spark
    run([sale(1, day=dt.date(2026, 1, 5))])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run([sale(1, day=dt.date(2026, 2, 5))])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r.date_key for r in warehouse.table("fact_sales").collect()] == [20260205]


def test_zero_revenue_margin(run):
    star = run([sale(1, price="0")]).warehouse.star()
    assert reports.executive_summary(star).first().overall_profit_margin is None
    assert reports.category_performance(star).first().profit_margin_pct is None


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_dense_keys_do_not_depend_on_partitioning(spark, staging, parts):
    ids = spark.range(0, 2000, 3).withColumn("id", F.col("id") * 7 % 4001).repartition(parts)
    rows = dense_keys(ids, "key", ["id"], staging, "ids").orderBy("id").collect()
    assert [r.key for r in rows] == list(range(1, 668))


def test_dense_keys_of_nothing(spark, staging):
    assert dense_keys(spark.range(0), "key", ["id"], staging, "none").count() == 0


def test_calendar(spark):
    days = date_dimension(spark, dt.date(2024, 2, 28), dt.date(2024, 12, 31))
    rows = {r.full_date: r for r in days.collect()}
    assert dt.date(2024, 2, 29) in rows and len(rows) == 308
    assert rows[dt.date(2024, 12, 30)].week_of_year == 1
    saturday, sunday = rows[dt.date(2024, 6, 1)], rows[dt.date(2024, 6, 2)]
    assert (saturday.is_weekend, saturday.day_of_week) == (True, 6)
    assert (sunday.is_weekend, sunday.day_of_week, sunday.day_name) == (True, 0, "Sunday   ")
    assert not rows[dt.date(2024, 6, 3)].is_weekend
    assert date_dimension(spark, DAY, DAY - dt.timedelta(days=1)).count() == 0
    plain = date_dimension(spark, DAY, DAY, pad_names=False).first()
    assert (plain.month_name, plain.day_name) == ("March", "Tuesday")


def test_rules(spark):
    df = spark.createDataFrame([(1, "abc"), (None, "abcdef"), (-1, None)], "n INT, t STRING")
    rules = [Rule("positive", "n > 0"), Rule("short", "char_length(t) <= 3"), Rule("there", "n IS NOT NULL")]
    counts = {r.rule: r.violations for r in quality.count_violations(df, rules).collect()}
    assert counts == {"positive": 1, "short": 1, "there": 1}
    listed = [r[quality.VIOLATIONS] for r in quality.with_violations(df, rules).collect()]
    assert listed == [[], ["short", "there"], ["positive"]]
    assert df.where(quality.passes(rules)).count() == 1


def test_keys_rules(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k INT")
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    table = spark.createDataFrame([(2,)], "id INT")
    assert [tuple(r) for r in quality.unmatched_keys(df, "k", table, "id").collect()] == [(1, 2)]


def test_enforce(spark, staging):
    df = spark.createDataFrame([(1,), (-1,)], "n INT")
    rule = [Rule("positive", "n > 0")]
    with pytest.raises(quality.ConstraintViolation):
        quality.enforce(df, rule, staging, "a")
    good, bad = quality.enforce(df, rule, staging, "b", quality.QUARANTINE)
    assert good.count() == bad.count() == 1
    good, bad = quality.enforce(df.where("n > 0"), rule, staging, "c")
    assert good.count() == 1 and bad is None


def test_group_figures(spark, staging):
    df = spark.createDataFrame([(1, 2), (1, 4), (2, 9)], "k INT, v INT")
    figures = {"n": F.count("*"), "top": F.max("v")}
    rows = with_group_figures(df, ["k"], staging, "groups", **figures).orderBy("k", "v")
    assert [tuple(r) for r in rows.collect()] == [(1, 2, 2, 4), (1, 4, 2, 4), (2, 9, 1, 9)]


def test_versions(spark, warehouse):
    """An unfinished refresh is not seen; the version before stays for readers, older ones go by age."""
    stores = spark.createDataFrame([(1, *STORE)], DIM_STORE.ddl)
    warehouse.create_database()
    warehouse.create_schema()
    assert warehouse.refresh(stores, DIM_STORE) == 1
    warehouse.write_version(stores.withColumn("city", F.lit("other")), DIM_STORE)
    assert [r.city for r in warehouse.table(DIM_STORE).collect()] == ["city"]
    more = stores.withColumns({"city": F.lit("added"), "store_key": F.lit(2), "store_id": F.lit(2)})
    warehouse.append(more, DIM_STORE)
    reader = warehouse.table(DIM_STORE)
    warehouse.keep_for = dt.timedelta(0)
    assert warehouse.refresh(stores, DIM_STORE) == 1
    assert sorted(r.city for r in reader.collect()) == ["added", "city"]
    names = [t.name for t in spark.catalog.listTables(warehouse.database)]
    assert sum(name.startswith("dim_store_v") for name in names) == 3  # now one segment, before two


STEPS = ["write_version", "count_version", "write_rejected", "publish"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_fails_at_any_step_changes_nothing(run, warehouse, monkeypatch, step):
    products = [(5, "five", "c", D(1), "s"), (7, "seven", "c", D(1), "s")]
    run([sale(1, product=5, price="18"), sale(2, product=7, price="2")], products=products)
    star = warehouse.star()
    before = {t: warehouse.table(t).collect() for t in TABLES_OF_STAR}
    top = reports.top_selling_products(star, 3).collect()

    def fail(*_args, **_kwargs):
        raise RuntimeError(step)

    more = [(3, "three", "c", D(1), "s"), *products, (9, "nine", "c", D(1), None)]
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, step, fail)
        with pytest.raises(RuntimeError, match=step):
            run([sale(1, product=3)], products=more, on_violation=quality.QUARANTINE)
    assert {t: warehouse.table(t).collect() for t in TABLES_OF_STAR} == before
    assert reports.top_selling_products(warehouse.star(), 3).collect() == top
    assert warehouse.rejected("dim_product") is None


def test_a_report_made_before_a_run_still_finishes_after_it(run, warehouse):
    run([sale(1)])
    summary = reports.executive_summary(warehouse.star())
    run([sale(1), sale(2)])
    assert summary.first().total_transactions == 1
    assert reports.executive_summary(warehouse.star()).first().total_transactions == 2


def test_rejected_rows_belong_to_their_run(run, warehouse):
    run([sale(1), sale(2, quantity=0)], on_violation=quality.QUARANTINE)
    assert warehouse.rejected("fact_sales").count() == 1
    run([sale(1)], on_violation=quality.QUARANTINE)
    assert warehouse.rejected("fact_sales") is None


@pytest.mark.parametrize("step", ["checked", "write_version", "write_rejected", "publish"])
def test_an_append_that_fails_at_any_step_changes_nothing(run, warehouse, monkeypatch, step):
    run([sale(1), sale(2)])
    good = warehouse.table(FACT_SALES)
    reader, before = warehouse.table(FACT_SALES), sorted(good.collect())
    more = good.withColumn("sale_id", F.col("sale_id") + 10)
    more = more.unionByName(good.withColumns({"sale_id": F.col("sale_id") + 20, "quantity": F.lit(0)}))

    def fail(*_args, **_kwargs):
        raise RuntimeError(step)

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, step, fail)
        with pytest.raises(RuntimeError, match=step):
            warehouse.append(more, FACT_SALES, quality.QUARANTINE)
    assert sorted(warehouse.table(FACT_SALES).collect()) == before
    assert warehouse.rejected(FACT_SALES) is None
    assert warehouse.append(more, FACT_SALES, quality.QUARANTINE) == 2
    assert sorted(reader.collect()) == before and warehouse.count(FACT_SALES) == 4
    assert warehouse.rejected(FACT_SALES).count() == 2


def test_an_append_is_one_switch(run, warehouse, monkeypatch):
    """While good and rejected rows are written, readers see the old ones; no statement writes into a
    published segment."""
    run([sale(1)])
    seen = []
    write_rejected, publish = warehouse.write_rejected, warehouse.publish

    def looking(method):
        def call(*args, **kwargs):
            seen.append((warehouse.count(FACT_SALES), warehouse.rejected(FACT_SALES)))
            return method(*args, **kwargs)

        return call

    monkeypatch.setattr(warehouse, "write_rejected", looking(write_rejected))
    monkeypatch.setattr(warehouse, "publish", looking(publish))
    good = warehouse.table(FACT_SALES)
    more = good.withColumn("sale_id", F.lit(7)).unionByName(good.withColumns({"sale_id": F.lit(8), "quantity": F.lit(0)}))
    warehouse.append(more, FACT_SALES, quality.QUARANTINE)
    assert seen == [(1, None), (1, None)]
    assert warehouse.count(FACT_SALES) == 2 and warehouse.rejected(FACT_SALES).count() == 1
    segments = warehouse.published()["fact_sales"]
    assert len(segments) == 2
    assert warehouse.append(good.where("1 = 0"), FACT_SALES) == 0  # no rows, no segment
    assert warehouse.published()["fact_sales"] == segments


def test_two_appends_at_a_time(run, warehouse, monkeypatch):
    """The second to finish is refused: its rows were checked against a table that is no more."""
    run([sale(1)])
    good = warehouse.table(FACT_SALES)
    write_version = warehouse.write_version

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(warehouse, "write_version", write_version)
        warehouse.append(good.withColumn("sale_id", F.lit(2)), FACT_SALES)
        return write_version(*args, **kwargs)

    monkeypatch.setattr(warehouse, "write_version", meanwhile)
    with pytest.raises(ConcurrentChange):
        warehouse.append(good.withColumn("sale_id", F.lit(2)), FACT_SALES)
    assert sorted(r.sale_id for r in warehouse.table(FACT_SALES).collect()) == [1, 2]


def test_compact(run, warehouse):
    run([sale(1), sale(2)])
    good = warehouse.table(FACT_SALES)
    for n in range(1, 4):
        warehouse.append(good.withColumn("sale_id", F.col("sale_id") + 10 * n), FACT_SALES)
    before = sorted(warehouse.table(FACT_SALES).collect())
    reader = warehouse.table(FACT_SALES)
    assert warehouse.compact(FACT_SALES) == 4 and warehouse.compact(FACT_SALES) == 1
    assert sorted(warehouse.table(FACT_SALES).collect()) == before == sorted(reader.collect())


def test_append_checks_every_constraint(run, warehouse):
    run([sale(1)])
    good = warehouse.table(FACT_SALES)
    bad = good.withColumns({"sale_id": F.lit(2), "quantity": F.lit(-5), "unit_price": F.lit(D(-1)), "store_key": F.lit(42)})
    with pytest.raises(quality.ConstraintViolation) as error:
        warehouse.append(bad, FACT_SALES)
    assert error.value.counts == {
        "check:quantity_positive": 1, "check:unit_price_not_negative": 1, "foreign_key:store_key": 1,
    }
    with pytest.raises(quality.ConstraintViolation) as error:
        warehouse.append(good, FACT_SALES)
    assert error.value.counts == {"unique:sale_id": 1}
    both = bad.unionByName(good.withColumn("sale_id", F.lit(3)))
    assert warehouse.append(both, FACT_SALES, quality.QUARANTINE) == 1
    assert sorted(r.sale_id for r in warehouse.table(FACT_SALES).collect()) == [1, 3]
    assert [r.sale_id for r in warehouse.rejected(FACT_SALES).collect()] == [2]
    with pytest.raises(quality.ConstraintViolation) as error:
        warehouse.refresh(warehouse.table(DIM_DATE).withColumn("day_name", F.lit(None).cast("string")), DIM_DATE)
    assert list(error.value.counts) == ["not_null:day_name"]


def test_staged_rows_go_with_the_run(run, tmp_path):
    run([sale(1)])
    assert not [p for p in (tmp_path / "staging").rglob("*.parquet")]

"""Golden values, worked out by hand, of small CSV extracts as of 2026-03-10; the command line."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from sparkmart.__main__ import main
from sparkmart.plans import reports
from sparkmart.plans.build import StarBuild
from sparkmart.plans.warehouse import Warehouse
from sparkmart.sources.extracts import extract_all
from sparkmart.sources.sql import run_query
from sparkmart.staging import Staging

FILES = {
    # Product 1 twice, product 4 with a negative cost.
    "products": '''product_id,product_name,category,unit_cost,supplier
1,"Lamp 27""",Light,4.00,one
2,Cup,Kitchen,1.50,two
1,Second lamp,Other,7.00,two
3,"Pan, large",Kitchen,10,two
4,Bowl,Kitchen,-1.00,two
''',
    # An address without an at sign, a customer without a last name.
    "customers": """customer_id,first_name,last_name,email,phone,city,state,registration_date
1,Ann,Ash,ann@x,,Rome,RM,2025-03-10
2,Bob,Birch,bob-at-x,555,Oslo,OS,2026-03-01
3,Cid,NULL,c@x,,Bonn,BN,2026-03-01
""",
    "stores": """store_id,store_name,city,state,region,manager_name,opening_date
1,North Shop,Rome,RM,North,Kim,2020-01-01
2,South Shop,Bari,BA,South,,2021-01-01
""",
    # A copy of 101; 104 by the dropped customer; 105 and 106 of unknown products; 107 negative;
    # 108 outside the window.
    "sales": """order_id,product_id,customer_id,store_id,quantity,price,order_date
100,1,1,1,2,10.00,2026-03-01
101,2,1,2,3,4.00,2026-03-01
102,3,2,1,1,25.00,2026-02-10
103,1,2,2,1,9.99,2026-01-05
101,2,1,2,9,9.00,2026-03-01
104,1,3,1,1,5.00,2026-03-02
105,9,1,1,1,5.00,2026-03-02
106,4,1,1,1,5.00,2026-03-02
107,1,1,1,-1,5.00,2026-03-02
108,1,1,1,1,5.00,2025-01-01
""",
}


@pytest.fixture(scope="module")
def samples(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


@pytest.fixture(scope="module")
def sample_build(spark, samples, tmp_path_factory):
    folder = tmp_path_factory.mktemp("samples")
    warehouse = Warehouse(spark, "samples_mart", location=str(folder / "mart"))
    staging = Staging(spark, str(folder))
    return StarBuild(extract_all(spark, samples), warehouse, AS_OF, staging=staging).run()


def money(*texts):
    return tuple(D(t) for t in texts)


def rows_of(report):
    return [tuple(r) for r in report.collect()]


@pytest.fixture(scope="module")
def star(sample_build):
    return sample_build.warehouse.star()


def test_executive_summary(star):
    row = reports.executive_summary(star).first()
    assert tuple(row) == (4, *money("66.99", "40.49"), 7, 2, 3, *money("16.75", "60.44"))


def test_regions(star):
    assert rows_of(reports.revenue_by_region(star)) == [
        ("North", 2, 3, *money("45.00", "27.00", "22.50")),
        ("South", 2, 4, *money("21.99", "13.49", "11.00")),
    ]


def test_months(star):
    assert rows_of(reports.monthly_sales_trends(star)) == [
        (2026, 3, "March    ", 2, 5, *money("32.00", "19.50", "16.00")),
        (2026, 2, "February ", 1, 1, *money("25.00", "15.00", "25.00")),
        (2026, 1, "January  ", 1, 1, *money("9.99", "5.99", "9.99")),
    ]


def test_categories(star):
    assert rows_of(reports.category_performance(star)) == [
        ("Kitchen", 2, 2, 4, *money("37.00", "22.50", "11.25", "60.81")),
        ("Light", 1, 2, 3, *money("29.99", "17.99", "9.00", "59.99")),
    ]


def test_stores(star):
    rows = rows_of(reports.sales_by_store(star))
    assert [r[0] for r in rows] == ["North Shop", "South Shop"]
    assert [r[4:] for r in rows] == [
        (2, 3, *money("45.00", "27.00", "22.50")), (2, 4, *money("21.99", "13.49", "11.00")),
    ]


def test_customer_patterns(star):
    assert rows_of(reports.customer_purchasing_patterns(star)) == [
        ("New", 1, 2, D("2.00"), *money("34.99", "17.50")),
        ("Established", 1, 2, D("2.00"), *money("32.00", "16.00")),
    ]


def test_top_lists(star):
    products = rows_of(reports.top_selling_products(star, 2))
    assert [p[:3] for p in products] == [('Lamp 27"', "Light", 3), ("Pan, large", "Kitchen", 1)]
    assert [p[3:5] for p in products] == [money("29.99", "17.99"), money("25.00", "15.00")]
    customers = rows_of(reports.top_customers(star, 3))
    assert [(c[0], *c[5:]) for c in customers] == [
        ("Bob Birch", 2, 2, *money("34.99", "17.50")), ("Ann Ash", 2, 5, *money("32.00", "16.00")),
    ]


def test_daily_summary(star):
    rows = reports.daily_sales_summary(star, 30, AS_OF).collect()
    assert [(r.full_date, r.transactions, r.revenue) for r in rows] == [
        (dt.date(2026, 3, 1), 2, D("32.00")), (dt.date(2026, 2, 10), 1, D("25.00")),
    ]


def test_views_agree_with_summary(star):
    sums = reports.sales_summary(star).agg(F.sum("revenue"), F.sum("profit"), F.count("*")).first()
    assert tuple(sums) == (D("66.99"), D("40.49"), 4)
    assert reports.monthly_revenue(star).agg(F.sum("total_revenue")).first()[0] == D("66.99")


def test_full_report_names(star):
    bundle = reports.full_report(star, AS_OF)
    assert list(bundle) == [
        "executive_summary", "top_products", "revenue_by_region", "monthly_trends",
        "store_performance", "customer_patterns", "top_customers", "category_performance",
        "daily_summary",
    ]


def test_dimension_cells(star):
    assert {r.product_name for r in star.product.collect()} == {'Lamp 27"', "Cup", "Pan, large"}
    customers = {r.customer_id: (r.email, r.phone) for r in star.customer.collect()}
    assert customers == {1: ("ann@x", None), 2: ("invalid@email.com", "555")}


def test_sql_text(spark, sample_build):
    sample_build.warehouse.register_views()
    text = "SELECT count(*) AS n FROM vw_sales_summary WHERE region = %(region)s"
    assert run_query(spark, text, {"region": "North"}).first().n == 2
    with pytest.raises(Exception):
        run_query(spark, "SELECT nothing FROM nowhere")


def test_stats(sample_build):
    assert sample_build.status == "SUCCESS"
    stats = sample_build.stats
    assert stats["extract"]["sales"] == {"records": 10, "columns": 7}
    assert stats["transform"] == {
        "products": {"input_records": 5, "output_records": 3, "removed_records": 2},
        "customers": {
            "input_records": 3, "output_records": 2, "removed_records": 1, "nulls_last_name": 1,
            "invalid_emails": 1,
        },
        "stores": {"input_records": 2, "output_records": 2, "removed_records": 0},
        "sales": {"input_records": 10, "output_records": 6, "removed_records": 4},
    }
    assert stats["load"]["dim_date"] == {"records_inserted": 151}
    assert stats["load"]["fact_sales"] == {
        "records_inserted": 4, "records_source": 6, "unresolved_product_id": 0,
        "unresolved_customer_id": 1, "unresolved_store_id": 0, "unresolved_order_date": 1,
    }
    assert [e["message"] for e in sample_build.validation_errors] == [
        "Found 1 negative values in unit_cost", "Found 1 negative values in quantity",
    ]
    summary = {r.metric: r.value for r in sample_build.summary_frame().where("stage = 'run'").collect()}
    assert summary["status"] == "SUCCESS" and int(summary["duration_seconds"]) >= 0


@pytest.mark.parametrize("as_of, sales", [(dt.date(2026, 6, 1), 3), (dt.date(2026, 12, 4), 0)])
def test_window(spark, samples, warehouse, staging, as_of, sales):
    run = StarBuild(extract_all(spark, samples), warehouse, as_of, staging=staging).run()
    assert run.stats["load"]["fact_sales"]["records_inserted"] == sales


def test_command_line_prints_every_row(spark, tmp_path, capsys):
    folder = tmp_path / "files"
    folder.mkdir()
    for name in ("products", "customers"):
        (folder / f"{name}.csv").write_text(FILES[name])
    heads = {name: text.split("\n")[0] for name, text in FILES.items()}
    stores = [f"{k},Shop {k:02d},Rome,RM,North,Kim,2020-01-01" for k in range(1, 26)]
    days = [AS_OF - dt.timedelta(days=d) for d in range(31)]
    sales = [f"{d * 100 + k},1,1,{k},1,5.00,{day}" for d, day in enumerate(days) for k in range(1, 26)]
    (folder / "stores.csv").write_text("\n".join([heads["stores"], *stores]))
    (folder / "sales.csv").write_text("\n".join([heads["sales"], *sales]))
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        main([str(folder), "--database", "printed_mart", "--location", str(tmp_path / "mart"), "--as-of", str(AS_OF)])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    printed = capsys.readouterr().out
    assert "store_performance: 25 rows" in printed and "daily_summary: 31 rows" in printed
    assert all(f"\nShop {k:02d}\t" in printed for k in range(1, 26))
    daily = printed[printed.index("daily_summary:") :]
    assert all(f"\n{day}\t" in daily for day in days)
    assert spark.table("printed_mart.report_store_performance").count() == 25

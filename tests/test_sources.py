"""CSV reading in detail, Parquet and database sources."""

from __future__ import annotations

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from sparkmart.operators.cleaning import keep_first
from sparkmart.plans.build import build_from_csv
from sparkmart.schemas import PRODUCTS, SALES
from sparkmart.sources import database
from sparkmart.sources.extracts import (
    INGEST_ORDER, UNREADABLE, csv_extract, extraction_stats, frame_extract, parquet_extract,
)

HEADER = "product_id,product_name,category,unit_cost,supplier\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_cells(spark, tmp_path):
    text = HEADER + '1,"Monitor 27""",A, 7.25,NA\n2,"a, b",nan,1e1,x\n\n3,short\n'
    data = csv_extract(spark, write(tmp_path / "p.csv", text), PRODUCTS).data
    rows = [tuple(r) for r in data.orderBy("product_id").collect()]
    assert rows[0][:3] == (1, 'Monitor 27"', "A") and str(rows[0][3]) == "7.250000"
    assert rows[0][4] is None
    assert rows[1][1:3] == ("a, b", None) and rows[1][3] == 10
    assert rows[2] == (3, "short", None, None, None)


def test_columns_are_bound_by_name(spark, tmp_path):
    text = "category,extra,product_name,product_id\nA,x,lamp,1\n"
    row = csv_extract(spark, write(tmp_path / "p.csv", text), PRODUCTS).data.first()
    assert tuple(row) == (1, "lamp", "A", None, None)


def test_required_column_must_be_there(spark, tmp_path):
    path = write(tmp_path / "p.csv", "product_id,product_name\n1,lamp\n")
    with pytest.raises(ValueError, match="category"):
        csv_extract(spark, path, PRODUCTS)


def test_long_row_stops_the_job(spark, tmp_path):
    extract = csv_extract(spark, write(tmp_path / "p.csv", HEADER + "1,a,b,2,c,d\n"), PRODUCTS)
    with pytest.raises(Exception, match="more cells"):
        extract.data.collect()


@pytest.mark.parametrize("second", [
    "product_id,category,product_name,unit_cost,supplier\n7,light,lamp,2,s\n",
    "product_id,product_name,category,unit_cost\n7,lamp,light,2\n",
])
def test_files_with_other_headers_stop_the_job(spark, tmp_path, second):
    folder = tmp_path / "products"
    folder.mkdir()
    write(folder / "a.csv", HEADER + "1,a,b,2,c\n" * 200)
    write(folder / "b.csv", second)
    extract = csv_extract(spark, str(folder), PRODUCTS)
    with pytest.raises(Exception, match="header.*[ab].csv|[ab].csv"):
        extract.data.collect()


def test_files_with_equal_headers(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    write(folder / "a.csv", HEADER + "1,a,b,2,c\n")
    write(folder / "b.csv", HEADER + "2,a,b\n")
    rows = csv_extract(spark, str(folder), PRODUCTS).data.orderBy("product_id").collect()
    assert [(r.product_id, r.supplier) for r in rows] == [(1, "c"), (2, None)]


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception):
        csv_extract(spark, str(tmp_path / "none.csv"), PRODUCTS).data.count()


def test_unreadable_cells(spark, tmp_path):
    path = write(tmp_path / "p.csv", HEADER + "1,a,b,cheap,c\n2,a,b,2,c\n")
    with pytest.raises(Exception, match="unit_cost cannot be read"):
        csv_extract(spark, path, PRODUCTS).data.collect()
    extract = csv_extract(spark, path, PRODUCTS, on_unreadable="quarantine")
    assert [r.product_id for r in extract.data.collect()] == [2]
    bad = extract.unreadable.first()
    assert (bad.product_id, bad[UNREADABLE]) == ("1", ["unit_cost"])


def test_stats(spark, tmp_path):
    path = write(tmp_path / "p.csv", HEADER + "1,a,b,2,c\n1,a,b,2,c\n")
    stats = extraction_stats(spark, {"products": csv_extract(spark, path, PRODUCTS)})
    assert stats == {"products": {"records": 2, "columns": 5, "file_path": path}}


def test_reader_options(spark, tmp_path):
    path = write(tmp_path / "p.csv", HEADER.replace(",", ";") + "1;a;b;2;c\n")
    assert csv_extract(spark, path, PRODUCTS, sep=";").data.first().supplier == "c"


def test_first_row_is_first_by_file_and_position(spark, tmp_path):
    """Files differ in size, so Spark packs them out of order; splits are a few rows long."""
    folder = tmp_path / "sales"
    folder.mkdir()
    line = "{},1,1,1,{},1.0,2026-01-01\n"
    for part, rows in enumerate((3, 500, 50)):
        head = ",".join(SALES.columns) + "\n"
        body = "".join(line.format(i % 200, part * 1000 + i) for i in range(rows))
        (folder / f"part-{part}.csv").write_text(head + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        extract = csv_extract(spark, str(folder), SALES)
        assert extract.rows.rdd.getNumPartitions() > 8
        first = keep_first(extract.rows, ["order_id"], INGEST_ORDER)
        got = {r.order_id: r.quantity for r in first.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: i if i < 3 else 1000 + i for i in range(200)}


def test_parquet_and_frames(spark, tmp_path):
    df = spark.range(5).select(
        F.col("id").alias("product_id"), F.lit("n").alias("product_name"), F.lit("c").alias("category")
    )
    df.write.parquet(str(tmp_path / "p"))
    extract = parquet_extract(spark, str(tmp_path / "p"), PRODUCTS)
    assert extract.data.columns == list(PRODUCTS.columns) and extract.data.count() == 5
    assert extract.order_by == INGEST_ORDER
    with pytest.raises(ValueError):
        frame_extract(df.drop("category"), PRODUCTS, ["product_id"])


def test_quarantined_extract_reaches_its_table(spark, tmp_path):
    folder = tmp_path / "src"
    folder.mkdir()
    write(folder / "products.csv", HEADER + "1,a,b,2,c\n2,a,b,much,c\n")
    write(folder / "stores.csv", "store_id,store_name,city,state,region,manager_name,opening_date\n1,s,c,ST,W,,2020-01-01\n")
    write(folder / "customers.csv", "customer_id,first_name,last_name,email,phone,city,state,registration_date\n1,a,b,a@b,,c,ST,2026-01-01\n")
    write(folder / "sales.csv", ",".join(SALES.columns) + "\n1,1,1,1,2,5.00,2026-03-01\n")
    run = build_from_csv(
        spark, str(folder), "unreadable_mart", AS_OF, "quarantine", str(tmp_path / "mart")
    )
    assert run.stats["load"]["products_rejected"] == {"records_inserted": 1}
    assert run.stats["extract"]["products"] == {"records": 2, "columns": 5}
    assert run.stats["transform"]["products"]["input_records"] == 1
    assert run.stats["load"]["fact_sales"]["records_inserted"] == 1


def test_database_options(monkeypatch):
    monkeypatch.setenv("DB_HOST", "db")
    monkeypatch.setenv("DB_PORT", "6000")
    monkeypatch.setenv("DB_NAME", "mart")
    monkeypatch.setenv("DB_USER", "me")
    monkeypatch.setenv("DB_PASSWORD", "secret")
    db = database.Database.from_environment()
    assert db.url == "jdbc:postgresql://db:6000/mart"
    options = database.read_options(db, "fact_sales", "sale_id", 1, 1000, 10)
    assert options["partitionColumn"] == "sale_id" and options["numPartitions"] == "10"
    assert options["user"] == "me" and options["password"] == "secret"
    assert "partitionColumn" not in database.read_options(db, "dim_store", one_task=True)
    with pytest.raises(ValueError):
        database.read_options(db, "dim_store")
    with pytest.raises(ValueError):
        database.read_options(db, "fact_sales", "sale_id")
    written = database.write_options(db, "fact_sales", connections=4)
    assert written["numPartitions"] == "4" and written["truncate"] == "true"
    monkeypatch.delenv("DB_USER")
    with pytest.raises(ValueError, match="DB_USER"):
        database.Database.from_environment()

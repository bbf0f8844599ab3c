"""S and K: scans, sinks, keys and table refreshes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks.registry import build, numbered, query, star
from sparkmart.operators.joins import absent_from
from sparkmart.operators.keys import dense_keys
from sparkmart.operators.quality import QUARANTINE, VIOLATIONS
from sparkmart.plans.calendar import describe_days
from sparkmart.plans.warehouse import Warehouse
from sparkmart.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_STORE, FACT_SALES, SOURCES
from sparkmart.session import sized
from sparkmart.sources import driver_tables
from sparkmart.sources.driver_tables import table
from sparkmart.sources.extracts import csv_extract, extract_all, extraction_stats
from sparkmart.sources.sql import run_query
from sparkmart.staging import Staging

CSV = {"header": True, "escape": '"', "quoteAll": False}
_WRITTEN: dict[tuple[str, str], str] = {}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**CSV).csv(path)


@query("S1_csv_scan", """
SELECT p_partkey AS product_id, 'the "' || p_name || '", new' AS product_name,
       p_type AS category, CAST(p_retailprice AS DECIMAL(18,6)) AS unit_cost,
       CASE WHEN p_brand = 'Brand#2' THEN NULL ELSE p_brand END AS supplier
FROM part
""")
def csv_scan(spark, sf_dir):
    """Names hold quotes and commas, one supplier is written as a null token, numbers are padded.
    What two extracts with their columns in different orders have in common is all of either."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit('the "'), "p_name", F.lit('", new')).alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit(" "), F.col("p_retailprice").cast("decimal(18,2)")).alias("unit_cost"),
        F.when(F.col("p_brand") == "Brand#2", "N/A").otherwise(F.col("p_brand")).alias("supplier"),
    )
    staging = Staging(spark)
    path = staging.path("products.csv")
    write_csv(parts, path)
    other = staging.path("reordered")
    write_csv(parts.select("supplier", "category", "product_id", "product_name", "unit_cost"), other)
    whole = csv_extract(spark, path, SOURCES["products"]).data
    again = csv_extract(spark, other, SOURCES["products"]).data
    return whole.intersectAll(again)


def written_extracts(spark, sf_dir):
    """The test tables as four CSV extracts, written once per Spark application."""
    application = (spark.sparkContext.applicationId, sf_dir)
    if application not in _WRITTEN:
        staging = Staging(spark)
        for name, extract in driver_tables.extracts(spark, sf_dir).items():
            with sized(spark, extract.data):
                write_csv(extract.data, staging.path(SOURCES[name].file))
        _WRITTEN[application] = staging.folder
    return extract_all(spark, _WRITTEN[application])


def _scan(name):
    return lambda spark, sf_dir: written_extracts(spark, sf_dir)[name].data


for _id, _name in (("S2", "sales"), ("S3", "customers"), ("S4", "products"), ("S5", "stores")):
    _columns = ", ".join(SOURCES[_name].columns)
    query(f"{_id}_{_name}_scan", f"SELECT {_columns} FROM {_name}_source")(_scan(_name))


@query("S6_all_scans", """
SELECT 'sales' AS source, count(*) AS records, CAST(sum(order_id) AS BIGINT) AS id_sum
FROM sales_source
UNION ALL SELECT 'customers', count(*), CAST(sum(customer_id) AS BIGINT) FROM customers_source
UNION ALL SELECT 'products', count(*), CAST(sum(product_id) AS BIGINT) FROM products_source
UNION ALL SELECT 'stores', count(*), CAST(sum(store_id) AS BIGINT) FROM stores_source
""")
def all_scans(spark, sf_dir):
    sums = [
        e.rows.agg(
            F.lit(name).alias("source"),
            F.count(F.lit(1)).alias("records"),
            F.sum(e.source.key).alias("id_sum"),
        )
        for name, e in written_extracts(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, sums)


@query("S7_scan_stats", """
SELECT 'sales' AS source, count(*) AS records, 7 AS columns FROM sales_source
UNION ALL SELECT 'customers', count(*), 8 FROM customers_source
UNION ALL SELECT 'products', count(*), 5 FROM products_source
UNION ALL SELECT 'stores', count(*), 7 FROM stores_source
""")
def scan_stats(spark, sf_dir):
    stats = extraction_stats(spark, written_extracts(spark, sf_dir))
    rows = [(name, s["records"], s["columns"]) for name, s in stats.items()]
    return spark.createDataFrame(rows, "source STRING, records BIGINT, columns INT")


@query("S8_key_scan", """
SELECT 'dim_product' AS dimension, product_id AS natural_key, product_key AS surrogate_key
FROM dim_product
UNION ALL SELECT 'dim_customer', customer_id, customer_key FROM dim_customer
UNION ALL SELECT 'dim_store', store_id, store_key FROM dim_store
""")
def key_scan(spark, sf_dir):
    warehouse = build(spark, sf_dir).warehouse
    scans = [
        warehouse.keys(t).select(
            F.lit(t.name).alias("dimension"),
            F.col(t.natural_key).alias("natural_key"),
            F.col(t.surrogate_key).alias("surrogate_key"),
        )
        for t in (DIM_PRODUCT, DIM_CUSTOMER, DIM_STORE)
    ]
    return reduce(DataFrame.unionByName, scans)


@query("S8_date_key_scan", "SELECT full_date, date_key FROM dim_date")
def date_key_scan(spark, sf_dir):
    return build(spark, sf_dir).warehouse.keys(DIM_DATE)


@query("S9_sql_text", """
SELECT region, count(*) AS sales FROM fact_sales JOIN dim_store USING (store_key)
WHERE quantity >= 20 GROUP BY region ORDER BY sales DESC, region LIMIT 3
""")
def sql_text(spark, sf_dir):
    build(spark, sf_dir).warehouse.register_views()
    text = """
        SELECT s.region, count(*) AS sales
        FROM fact_sales f JOIN dim_store s ON f.store_key = s.store_key
        WHERE f.quantity >= %(least)s GROUP BY s.region
        ORDER BY sales DESC, s.region LIMIT :top
    """
    return run_query(spark, text, {"least": 20, "top": 3})


@query("Q8_parameters", """
SELECT year, month, total FROM (
  SELECT year, month, count(*) AS total FROM fact_sales JOIN dim_date USING (date_key)
  GROUP BY year, month) WHERE total >= 590 AND year BETWEEN 1996 AND 1999
""")
def parameters(spark, sf_dir):
    build(spark, sf_dir).warehouse.register_views()
    text = """
        SELECT year, month, total_transactions AS total FROM vw_monthly_revenue
        WHERE total_transactions >= %(least)s AND year BETWEEN %(first)s AND %(last)s
    """
    return run_query(spark, text, {"least": 590, "first": 1996, "last": 1999})


def _fresh_warehouse(spark) -> Warehouse:
    warehouse = Warehouse(
        spark, f"mart_{uuid.uuid4().hex[:12]}", location=Staging(spark).path("warehouse")
    )
    warehouse.create_database()
    warehouse.create_schema()
    return warehouse


@query("K1_star_schema", """
SELECT 'dim_date' AS table_name, count(*) AS before, CAST(0 AS BIGINT) AS after FROM dim_date
UNION ALL SELECT 'dim_product', count(*), 0 FROM dim_product
UNION ALL SELECT 'dim_customer', count(*), 0 FROM dim_customer
UNION ALL SELECT 'dim_store', count(*), 0 FROM dim_store
""")
def star_schema(spark, sf_dir):
    """Creating the schema (and, before it, the database) again empties its tables."""
    source = build(spark, sf_dir).warehouse
    warehouse = _fresh_warehouse(spark)
    before = {DIM_DATE.name: warehouse.add_dates(source.table(DIM_DATE))}
    for table in (DIM_PRODUCT, DIM_CUSTOMER, DIM_STORE):
        before[table.name] = warehouse.refresh(source.table(table), table)
    warehouse.create_database()
    warehouse.create_schema()
    rows = [(name, count, warehouse.count(name)) for name, count in before.items()]
    return spark.createDataFrame(rows, "table_name STRING, before BIGINT, after BIGINT")


@query("K2_database_if_absent", "SELECT * FROM dim_product")
def database_if_absent(spark, sf_dir):
    """Creating a database that is there already leaves its tables alone."""
    warehouse = _fresh_warehouse(spark)
    warehouse.refresh(build(spark, sf_dir).warehouse.table(DIM_PRODUCT), DIM_PRODUCT)
    warehouse.create_database()
    return warehouse.table(DIM_PRODUCT)


@query("K3_dimension_refresh", "SELECT * FROM dim_customer")
def dimension_refresh(spark, sf_dir):
    """The second refresh replaces the rows of the first."""
    warehouse = _fresh_warehouse(spark)
    customers = build(spark, sf_dir).warehouse.table(DIM_CUSTOMER)
    warehouse.refresh(customers.withColumn("city", F.lit("old")), DIM_CUSTOMER)
    warehouse.refresh(customers, DIM_CUSTOMER)
    return warehouse.table(DIM_CUSTOMER)


def _with_dimensions(spark, sf_dir) -> tuple[Warehouse, DataFrame]:
    """A warehouse with the dimensions of the star and no sales yet, and the star's sales."""
    built = build(spark, sf_dir).warehouse
    warehouse = _fresh_warehouse(spark)
    warehouse.append(built.table(DIM_DATE), DIM_DATE)
    for dimension in (DIM_PRODUCT, DIM_CUSTOMER, DIM_STORE):
        warehouse.refresh(built.table(dimension), dimension)
    return warehouse, built.table(FACT_SALES)


@query("K4_fact_refresh", "SELECT * FROM fact_sales")
def fact_refresh(spark, sf_dir):
    """The second refresh replaces the sales of the first."""
    warehouse, sales = _with_dimensions(spark, sf_dir)
    warehouse.refresh(sales.where("quantity > 10").withColumn("quantity", F.lit(1)), FACT_SALES)
    warehouse.refresh(sales, FACT_SALES)
    return numbered(warehouse.table(FACT_SALES)).drop("created_at")


@query("K5_append", """
SELECT * FROM dim_store
""")
def append(spark, sf_dir):
    """Two appends, the second with its columns in another order."""
    warehouse = _fresh_warehouse(spark)
    stores = build(spark, sf_dir).warehouse.table(DIM_STORE)
    warehouse.append(stores.where("region = 'ASIA'"), DIM_STORE)
    others = stores.where("region <> 'ASIA'")
    warehouse.append(others.select(*reversed(others.columns)), DIM_STORE)
    return warehouse.table(DIM_STORE)


BAD_STORES = """
SELECT store_id AS id, 'max_length:city,unique:store_key' AS broken FROM dim_store WHERE region = 'ASIA'
UNION ALL SELECT store_id, 'not_null:region' FROM dim_store WHERE region <> 'ASIA' AND store_id % 3 = 0
"""


@query("K5_append_checked", BAD_STORES + """
UNION ALL SELECT store_id, 'kept' FROM dim_store WHERE region = 'ASIA'
UNION ALL SELECT store_id, 'kept' FROM dim_store WHERE region <> 'ASIA' AND store_id % 3 <> 0
""")
def append_checked(spark, sf_dir):
    """Stores whose key is there already or whose region is missing are set apart, not added."""
    warehouse = _fresh_warehouse(spark)
    stores = build(spark, sf_dir).warehouse.table(DIM_STORE)
    warehouse.append(stores.where("region = 'ASIA'"), DIM_STORE)
    again = F.col("region") == "ASIA"
    bad = stores.withColumns({
        "city": F.when(again, F.repeat(F.lit("x"), F.lit(101))).otherwise(F.col("city")),
        "store_id": F.when(again, -F.col("store_id")).otherwise(F.col("store_id")),
        "region": F.when(again | (F.col("store_id") % 3 != 0), F.col("region")),
    })
    warehouse.append(bad, DIM_STORE, QUARANTINE)
    kept = warehouse.table(DIM_STORE).select(F.col("store_id").alias("id"), F.lit("kept").alias("broken"))
    names = F.concat_ws(",", VIOLATIONS).alias("broken")
    return kept.unionByName(warehouse.rejected(DIM_STORE).select(F.abs("store_id").alias("id"), names))


@query("K5_append_fact", """
SELECT sale_id, CASE WHEN sale_id % 3 = 1 THEN 'foreign_key:store_key' ELSE 'check:quantity_positive' END AS broken
FROM fact_sales WHERE sale_id % 3 <> 0
""")
def append_fact(spark, sf_dir):
    """Of the sales, a third has an unknown store and a third no quantity; an append to sales that
    are there sets both apart."""
    warehouse, sales = _with_dimensions(spark, sf_dir)
    number = F.col("sale_id") % 3
    sales = numbered(sales)
    warehouse.append(sales.where(number == 0), FACT_SALES)
    bad = sales.where(number != 0).withColumns({
        "store_key": F.when(number == 1, F.lit(-1)).otherwise(F.col("store_key")),
        "quantity": F.when(number == 2, F.lit(0)).otherwise(F.col("quantity")),
    })
    warehouse.append(bad, FACT_SALES, QUARANTINE)
    return warehouse.rejected(FACT_SALES).select("sale_id", F.concat_ws(",", VIOLATIONS).alias("broken"))


@query("K5_fact_in_appends", """
SELECT *, CASE WHEN date_month < 199701 THEN 'appended' ELSE 'late' END AS came FROM fact_sales
""")
def fact_in_appends(spark, sf_dir):
    """The sales in three appends, the last with its columns in another order and with all the rows
    of the first once more, which are set apart; what was appended is read before and after."""
    warehouse, sales = _with_dimensions(spark, sf_dir)
    early = sales.where("date_month < 199701")
    warehouse.append(early.where("store_key % 2 = 0"), FACT_SALES)
    warehouse.append(early.where("store_key % 2 = 1"), FACT_SALES)
    seen = warehouse.table(FACT_SALES).select("sale_id", F.lit("appended").alias("came"))
    again = sales.where("date_month >= 199701 OR store_key % 2 = 0")
    warehouse.append(again.select(*reversed(again.columns)), FACT_SALES, QUARANTINE)
    whole = warehouse.table(FACT_SALES).join(seen, "sale_id", "left").fillna("late", ["came"])
    return numbered(whole).drop("created_at")


@query("K5_repeated_keys", """
SELECT 'unique:store_id' AS broken, count(*) AS n FROM fact_sales WHERE store_key % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'unique:store_id,unique:store_key', count(*) FROM fact_sales WHERE store_key % 3 = 1
UNION ALL SELECT 'unique:store_key', count(*) FROM fact_sales WHERE store_key % 3 = 2
""")
def repeated_keys(spark, sf_dir):
    """As many new stores as there are sales: their ids or keys repeat, as often as a store has sales,
    or are there already."""
    built = build(spark, sf_dir).warehouse
    warehouse = _fresh_warehouse(spark)
    stores = built.table(DIM_STORE)
    warehouse.append(stores, DIM_STORE)
    sales = numbered(built.table(FACT_SALES)).select("store_key", "sale_id").join(stores, "store_key")
    new, kind = -F.col("sale_id"), F.col("store_key") % 3
    bad = sales.withColumns({
        "store_key": F.when(kind == 0, new).otherwise(F.col("store_key")),
        "store_id": F.when(kind == 2, new).otherwise(F.col("store_id")),
    }).drop("sale_id")
    warehouse.append(bad, DIM_STORE, QUARANTINE)
    names = F.array_join(F.array_sort(VIOLATIONS), ",").alias("broken")
    return warehouse.rejected(DIM_STORE).groupBy(names).agg(F.count(F.lit(1)).alias("n"))


@query("K5_compact", "SELECT * FROM dim_customer")
def compact(spark, sf_dir):
    """Four appends made one segment."""
    warehouse = _fresh_warehouse(spark)
    customers = build(spark, sf_dir).warehouse.table(DIM_CUSTOMER)
    for part in range(4):
        warehouse.append(customers.where(F.col("customer_key") % 4 == part), DIM_CUSTOMER)
    warehouse.compact(DIM_CUSTOMER)
    if len(warehouse.published()[DIM_CUSTOMER.name]) != 1:
        raise AssertionError("more than one segment is left")
    return warehouse.table(DIM_CUSTOMER)


@query("K6_insert_if_absent", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date,
       CASE WHEN year(o_orderdate) < 1998 THEN 'kept'
            ELSE rpad(monthname(o_orderdate), 9, ' ') END AS month_name
FROM orders
""")
def insert_if_absent(spark, sf_dir):
    """Days before 1998 are in the table already, with another name that must stay."""
    warehouse = _fresh_warehouse(spark)
    orders = table(spark, sf_dir, "orders")
    days = describe_days(orders.select(F.to_date("o_orderdate").alias("full_date")).distinct())
    old = days.where("year < 1998").withColumn("month_name", F.lit("kept"))
    warehouse.append(old, DIM_DATE)
    warehouse.add_dates(days)
    return warehouse.table(DIM_DATE).select("full_date", "month_name")


@query("K6_absent_days", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '2000-01-01'
""")
def absent_days(spark, sf_dir):
    known = star(spark, sf_dir).date.where("full_date >= DATE '2000-01-01'")
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    return absent_from(days.distinct(), known, "full_date")


@query("K7_dense_keys", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank
FROM orders
""")
def price_ranks(spark, sf_dir):
    """Orders numbered 1..n from the dearest on."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (-F.col("o_totalprice")).alias("falling_price")
    )
    order_by = ["falling_price", "o_orderkey"]
    numbers = dense_keys(orders, "price_rank", order_by, Staging(spark), "ranked_orders")
    return numbers.select("o_orderkey", "price_rank")


@query("K8_created_at", """
SELECT date_month, count(*) AS sales, count(*) AS stamped FROM fact_sales GROUP BY date_month
""")
def created_at(spark, sf_dir):
    sales = star(spark, sf_dir).sales
    return sales.groupBy("date_month").agg(
        F.count(F.lit(1)).alias("sales"), F.count("created_at").alias("stamped")
    )


LOADED = """
SELECT 'dim_date' AS table_name, count(*) AS records FROM dim_date
UNION ALL SELECT 'dim_product', count(*) FROM dim_product
UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
UNION ALL SELECT 'dim_store', count(*) FROM dim_store
UNION ALL SELECT 'fact_sales', count(*) FROM fact_sales
"""


@query("K9_load_counts", LOADED)
def load_counts(spark, sf_dir):
    stats = build(spark, sf_dir).stats_frame("load")
    inserted = stats.where("metric = 'records_inserted'")
    return inserted.select("table_name", F.col("value").alias("records"))

"""The order-entry test tables, seen as the four extracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.schemas import CUSTOMERS, PRODUCTS, SALES, STORES
from sparkmart.sources.extracts import Extract, frame_extract

AS_OF = dt.date(2001, 8, 2)
DATE_RANGE = (dt.date(1995, 1, 1), dt.date(2001, 9, 1))

# lineitem has no unique column; together these order its rows fully.
LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> Extract:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_orderdate").alias("order_date"),
        *LINE_ORDER,
    )
    made_of = {
        "product_id": "l_partkey", "store_id": "l_suppkey", "quantity": "l_quantity", "price": "l_extendedprice",
    }
    return frame_extract(rows, SALES, LINE_ORDER, made_of)


def products(spark: SparkSession, sf_dir: str) -> Extract:
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_cost"),
        F.col("p_brand").alias("supplier"),
    )
    return frame_extract(rows, PRODUCTS, ("product_name", "category", "unit_cost", "supplier"))


def customers(spark: SparkSession, sf_dir: str) -> Extract:
    at_sign = F.when(F.col("c_custkey") % 10 == 0, "").otherwise("@")
    age = (F.col("c_custkey") % 500).cast("int")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat("c_custkey", at_sign, F.lit("x.test")).alias("email"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("c_mktsegment").alias("state"),
        F.date_sub(F.lit(AS_OF), age).alias("registration_date"),
    )
    return frame_extract(rows, CUSTOMERS, ("first_name", "last_name", "email", "city", "state"))


def stores(spark: SparkSession, sf_dir: str) -> Extract:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    places = nations.join(regions, nations.n_regionkey == regions.r_regionkey)
    suppliers = table(spark, sf_dir, "supplier")
    rows = suppliers.join(places, suppliers.s_nationkey == places.n_nationkey).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("n_nationkey").cast("string").alias("state"),
        F.col("r_name").alias("region"),
        F.lit(dt.date(1995, 1, 1)).alias("opening_date"),
    )
    return frame_extract(rows, STORES, ("store_name", "city", "state", "region"))


def extracts(spark: SparkSession, sf_dir: str) -> dict[str, Extract]:
    readers = {"sales": sales, "customers": customers, "products": products, "stores": stores}
    return {name: read(spark, sf_dir) for name, read in readers.items()}

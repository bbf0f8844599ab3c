"""The sales fact: natural keys resolved to surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from sparkmart.functions.dates import month_of_key
from sparkmart.operators.joins import lookup
from sparkmart.operators.quality import unpivot_counts
from sparkmart.plans.transforms import with_measures


@dataclass(frozen=True)
class Dimensions:
    product: DataFrame
    customer: DataFrame
    store: DataFrame
    date: DataFrame


def resolve_keys(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """Sales with the four surrogate keys; a sale that one lookup misses is left out.

    The date comes first: it is the smallest table and its window the most selective, so what it
    drops is not shuffled for the others. The customer, likely the largest, comes last.
    """
    dated = sales.withColumn("order_date", F.to_date("order_date"))
    keyed = lookup(dated, dims.date, "order_date", ["date_key"], table_key="full_date")
    if "product_key" in sales.columns:
        keyed = keyed.where(F.col("product_key").isNotNull())
    else:
        keyed = lookup(keyed, dims.product, "product_id", ["product_key"])
    keyed = lookup(keyed, dims.store, "store_id", ["store_key"])
    return lookup(keyed, dims.customer, "customer_id", ["customer_key"])


def fact_inputs(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """What the fact is made of. Half as wide as the fact: exact products are long numbers."""
    return resolve_keys(sales, dims).select(
        "order_id", "product_key", "customer_key", "store_key", "date_key",
        "quantity", "price", "unit_cost",
    )


def with_fact_measures(inputs: DataFrame) -> DataFrame:
    return with_measures(inputs).withColumn("unit_price", F.col("price"))


def fact_rows(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """The fact's columns, still unrounded, with order_id to sort by."""
    return with_fact_measures(fact_inputs(sales, dims)).drop("price", "unit_cost")


#: A task of the fact's write has about so many sales at least, lest files become tiny.
LEAST_ROWS = 100_000


def in_order(inputs: DataFrame, sales: DataFrame, dims: Dimensions, rows: int | None = None) -> DataFrame:
    """Inputs dealt to tasks by (date, order), sorted there, with sale_id rising in that order.

    Their month, the fact's partition, leads the sort, which changes nothing in the order, but
    spares the write a sort of its own by partition.
    The bounds come from the staged sales, per day: their number and their first and last order.
    That is one row for each day of the calendar, so it is broadcast. Within a day, orders are
    dealt by their number, so that a hot day falls into many tasks. These are as many as the
    session's shuffle partitions, or fewer where the rows, if their number is given, are few.
    """
    per_day = (
        sales.groupBy(F.to_date("order_date").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("order_id").alias("_lo"), F.max("order_id").alias("_hi"))
        .join(dims.date.select("full_date", F.col("date_key").alias("_day")), "full_date")
    )
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    days = per_day.select(
        F.col("_day").alias("date_key"), "_n", "_lo", "_hi",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all"),
    )
    parts = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts if rows is None else max(1, min(parts, -(-rows // LEAST_ROWS)))
    inside = (F.col("order_id") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1)
    place = (F.col("_before") + inside * F.col("_n")) / F.col("_all")
    part = F.least(F.floor(place * parts), F.lit(parts - 1)).cast("int")
    dealt = inputs.join(F.broadcast(days), "date_key").withColumn("_part", part)
    dated = dealt.repartitionById(parts, F.col("_part")).withColumn("date_month", month_of_key(F.col("date_key")))
    ordered = dated.sortWithinPartitions("date_month", "date_key", "order_id")
    numbered = ordered.withColumn("sale_id", F.monotonically_increasing_id() + 1)
    return numbered.select("sale_id", *inputs.columns, "date_month")


def lookup_figures(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """One row: the number of sales, and per lookup those with a value but no match (a sale may
    miss several). The sales are read once and meet each dimension's keys in turn."""
    lookups = [
        ("product_id", dims.product, "product_id"),
        ("customer_id", dims.customer, "customer_id"),
        ("store_id", dims.store, "store_id"),
        ("order_date", dims.date, "full_date"),
    ]
    joined = sales.select("product_id", "customer_id", "store_id", F.to_date("order_date").alias("order_date"))
    for column, table, key in lookups:
        known = table.select(F.col(key).alias(column), F.lit(True).alias(f"_{column}"))
        joined = joined.join(known, column, "left")
    missed = [
        F.count_if(F.col(column).isNotNull() & F.col(f"_{column}").isNull()).alias(column)
        for column, _, _ in lookups
    ]
    return joined.agg(F.count(F.lit(1)).alias("sales"), *missed)


def unresolved(sales: DataFrame, dims: Dimensions) -> DataFrame:
    """Per lookup, the number of sales without a match."""
    return unpivot_counts(lookup_figures(sales, dims).drop("sales"), "lookup", "unresolved")

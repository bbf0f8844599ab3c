"""The date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkmart.functions.dates import calendar


def days_between(first: Column, last: Column) -> Column:
    """One row per day from first to last, both included; none if first is after last."""
    return F.explode(
        F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    )


def describe_days(days: DataFrame, column: str = "full_date", pad_names: bool = True) -> DataFrame:
    """The date dimension's columns for a column of days."""
    return days.select(*[c.alias(n) for n, c in calendar(F.col(column), pad_names).items()])


def date_dimension(
    spark: SparkSession, first: dt.date, last: dt.date, pad_names: bool = True
) -> DataFrame:
    one_row = spark.range(1)
    days = one_row.select(days_between(F.lit(first), F.lit(last)).alias("full_date"))
    return describe_days(days, pad_names=pad_names)

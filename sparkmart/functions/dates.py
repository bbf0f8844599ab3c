"""Calendar attributes and the age of a customer relationship."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Upper bound in days (inclusive) and name of each age band.
SEGMENT_BANDS = [(30, "New"), (90, "Recent"), (365, "Established")]
OLDEST_SEGMENT = "Loyal"
PADDED_NAME_WIDTH = 9


def date_key(day: Column) -> Column:
    """yyyymmdd as an int; keeps date order, so it can be range-filtered."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def date_key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def month_of_key(key: Column) -> Column:
    """yyyymm partition value of a yyyymmdd key."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def segment(registered: Column, as_of: dt.date) -> Column:
    """Age band of a registration date; NULL for no date and for ages of zero days or less."""
    age = F.date_diff(F.lit(as_of), registered)
    bands = F.when(age <= 0, F.lit(None).cast("string"))
    for upper, name in SEGMENT_BANDS:
        bands = bands.when(age <= upper, name)
    return bands.when(age.isNotNull(), OLDEST_SEGMENT)


def padded(name: Column, pad: bool) -> Column:
    return F.rpad(name, PADDED_NAME_WIDTH, " ") if pad else name


def calendar(day: Column, pad_names: bool = True) -> dict[str, Column]:
    """Every column of the date dimension, by name, for one day."""
    day_of_week = F.dayofweek(day) - 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": padded(F.date_format(day, "MMMM"), pad_names),
        "day": F.day(day),
        "day_of_week": day_of_week,
        "day_name": padded(F.date_format(day, "EEEE"), pad_names),
        "week_of_year": F.weekofyear(day),
        "is_weekend": day_of_week.isin(0, 6),
        "fiscal_year": F.year(day),
    }

"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkmart.session import sized
from sparkmart.staging import Staging

# monotonically_increasing_id() holds the partition above this many bits, the row below.
ROW_BITS = 33
POSITION = "_position"


def stage_in_order(
    df: DataFrame,
    order_by: Sequence[str],
    staging: Staging,
    name: str,
    figures: dict[str, Column] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """Range-partition, sort and write the rows, each with its position in that order.

    The figures may be of columns that derive adds; those are neither shuffled nor written.

    The sort columns must identify a row. Range bounds come from a sample, but the order over all
    partitions, and with it the later numbering, does not depend on them.
    """
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(POSITION, F.monotonically_increasing_id())
    )
    described = derive(ordered) if derive else ordered
    return staging.write(described, name, figures, columns=ordered.columns)


def number_rows(staged: DataFrame, key: str) -> DataFrame:
    """Number staged rows 1..n in their order.

    One count per written partition gives its first number. That list has as many rows as the
    write had tasks, whatever the size of the data, so it is broadcast and its running sum may
    use one task. The rows themselves are not shuffled.
    """
    part = F.shiftright(POSITION, ROW_BITS)
    row = F.col(POSITION).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = staged.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    numbered = staged.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(key, F.col("_start") + row + 1).drop("_part", "_start", POSITION)


def dense_keys(
    df: DataFrame, key: str, order_by: Sequence[str], staging: Staging, name: str
) -> DataFrame:
    """The rows with key numbered 1..n in the given order."""
    with sized(df.sparkSession, df):
        staged, _ = stage_in_order(df, order_by, staging, name)
    return number_rows(staged, key)

"""Key lookups, attached group figures and insert-if-absent.

No join is hinted. Dimensions may be of any size, so Spark broadcasts a side only when its
measured size is below spark.sql.autoBroadcastJoinThreshold and sorts and merges otherwise; a hot
key on the sales side is then split over tasks by the adaptive skew join, as every looked-up side
holds one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.staging import Staging


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str,
    take: Sequence[str],
    table_key: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Bring columns of a table that has one row per key; inner drops rows without a match."""
    pairs = table.select(F.col(table_key or on).alias(on), *take)
    return df.join(pairs, on, how)


def with_group_figures(
    df: DataFrame, keys: Sequence[str], staging: Staging, name: str, **figures: Column
) -> DataFrame:
    """Every row, with figures of its whole group.

    The figures, one row per group, are written first. Spark then knows their size, and can
    broadcast them or, beyond that, split a hot group of rows over tasks: it does not split a join
    whose other side is still an aggregate, and a window would hold the group in one task.
    """
    groups = df.groupBy(*keys).agg(*[f.alias(n) for n, f in figures.items()])
    staged, _ = staging.write(groups, name)
    return df.join(staged, list(keys))


def absent_from(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """The new rows whose key the existing table does not hold yet."""
    return new.join(existing.select(key), key, "left_anti")

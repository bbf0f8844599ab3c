"""Deduplication, required columns, sign checks and value repair."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values, here and in the three messages below: what stands for a bad address, what runs report.
INVALID_EMAIL = "invalid@email.com"


def keep_first(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key, the first in the given order; without keys, distinct rows.

    Rows equal in that order are told apart by their other columns, so the result is always the
    same. copies names a column to hold the number of rows that the key had. Every map task merges its
    copies before the shuffle and sends one row per key at most, so a key with very many copies
    does not make a large group anywhere.
    """
    if not keys:
        return df.distinct()
    if not order_by:
        raise ValueError("keep_first needs an order to say which row is first")
    ordered = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ordered]
    first = F.min(F.struct(*ordered, *rest)).alias("_first")
    merged = df.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("_copies"))
    columns = [F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns]
    if copies:
        columns.append(F.col("_copies").alias(copies))
    return merged.select(*columns)


def present(columns: Iterable[str]) -> Column:
    """True where every one of the columns has a value."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def null_counts(columns: Iterable[str]) -> dict[str, Column]:
    return {f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in columns}


def _subsets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for size in range(len(columns) + 1) for s in combinations(columns, size)]


def _figure(kind: str, filtered: Iterable[str]) -> str:
    return f"{kind}|{','.join(filtered)}"


def sign_counts(columns: Sequence[str], among: Column) -> dict[str, Column]:
    """Figures, taken in one pass, that tell what the sign rule does to the rows among.

    The rule goes column by column: once any value left is negative, only rows with a value >= 0
    stay, so NULLs go too; a column without negatives is left alone, its NULLs included. Which rows a column sees depends on which earlier columns had negatives, so the rows are
    counted for each case: seven figures for two columns.
    """
    figures = {}
    for filtered in _subsets(columns):
        kept = reduce(Column.__and__, [F.col(c) >= 0 for c in filtered], among)
        figures[_figure("kept", filtered)] = F.count_if(kept)
    for i, name in enumerate(columns):
        for filtered in _subsets(columns[:i]):
            seen = reduce(Column.__and__, [F.col(c) >= 0 for c in filtered], among)
            figures[_figure(f"negative:{name}", filtered)] = F.count_if(seen & (F.col(name) < 0))
    return figures


def flagged_columns(columns: Sequence[str], figures: dict[str, int]) -> dict[str, int]:
    """The columns that have negatives, in order, each with its count."""
    flagged: dict[str, int] = {}
    for name in columns:
        count = figures.get(_figure(f"negative:{name}", flagged)) or 0
        if count:
            flagged[name] = count
    return flagged


def kept_rows(flagged: Iterable[str], figures: dict[str, int]) -> int:
    """How many rows remain once the flagged columns are filtered."""
    return figures.get(_figure("kept", flagged)) or 0


def keep_non_negative(df: DataFrame, flagged: Iterable[str]) -> DataFrame:
    """The sign rule for columns already known to have negatives."""
    for name in flagged:
        df = df.where(F.col(name) >= 0)
    return df


def null_message(column: str, count: int) -> str:
    return f"Found {count} null values in required column: {column}"


def email_message(count: int) -> str:
    return f"Found {count} invalid email addresses"


def negative_message(column: str, count: int) -> str:
    return f"Found {count} negative values in {column}"


def has_at_sign(email: Column) -> Column:
    return F.coalesce(F.contains(email, F.lit("@")), F.lit(False))


def repair_email(df: DataFrame, column: str = "email") -> DataFrame:
    """Replace an address without an at sign, or without any value, by a fixed one."""
    repaired = F.when(has_at_sign(F.col(column)), F.col(column)).otherwise(F.lit(INVALID_EMAIL))
    return df.withColumn(column, repaired)

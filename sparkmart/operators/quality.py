"""Declared constraints as data-quality checks, and counts in long form."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.schemas import Rule
from sparkmart.staging import Staging

FAIL, QUARANTINE = "fail", "quarantine"
VIOLATIONS = "_violations"


class ConstraintViolation(ValueError):
    """Rows break a declared constraint. Carries the number of rows per rule."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.table, self.counts = table, counts
        listed = ", ".join(f"{name} ({count} rows)" for name, count in counts.items())
        super().__init__(f"{table} breaks {listed}")


def broken(rule: Rule) -> Column:
    """True only where the test is false: NULL passes, as in a SQL CHECK."""
    return ~F.coalesce(F.expr(rule.test), F.lit(True))


def passes(rules: Sequence[Rule]) -> Column:
    """True where no rule is broken."""
    ok = F.lit(True)
    for rule in rules:
        ok = ok & ~broken(rule)
    return ok


def rule_counts(rules: Iterable[Rule]) -> dict[str, Column]:
    return {f"broken:{r.name}": F.count_if(broken(r)) for r in rules}


def broken_rules(figures: dict[str, int]) -> dict[str, int]:
    """Rule name to number of rows, for the rules that some row breaks."""
    prefix = "broken:"
    return {
        name[len(prefix):]: count
        for name, count in figures.items()
        if name.startswith(prefix) and count
    }


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Every row with the list of names of the rules it breaks."""
    names = F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules])
    return df.withColumn(VIOLATIONS, F.array_compact(names))


def unpivot_counts(figures: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row frame of counts as one row per column."""
    return figures.unpivot([], figures.columns, name, value)


def count_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of rows that break it, all rules in one pass."""
    counts = df.agg(*[F.count_if(broken(r)).alias(r.name) for r in rules])
    return unpivot_counts(counts, "rule", "violations")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. NULL keys may repeat."""
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def unmatched_keys(
    df: DataFrame, column: str, table: DataFrame, table_key: str | None = None
) -> DataFrame:
    """Values without a row in the table, with their number of rows.

    Rows are counted per value first, so that the anti join sees each value once.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column)
    counted = values.agg(F.count(F.lit(1)).alias("rows"))
    known = table.select(F.col(table_key or column).alias(column))
    return counted.join(known, column, "left_anti")


def enforce(
    df: DataFrame,
    rules: Sequence[Rule],
    staging: Staging,
    name: str,
    on_violation: str = FAIL,
) -> tuple[DataFrame, DataFrame | None]:
    """Stage df and check it while it is written, all rules in one pass.

    fail: raise with the counts if any row breaks a rule. quarantine: give back the good rows and
    the bad ones apart, the latter with the names of the rules they break.
    """
    staged, figures = staging.write(df, name, rule_counts(rules))
    counts = broken_rules(figures)
    if not counts:
        return staged, None
    if on_violation == FAIL:
        raise ConstraintViolation(name, counts)
    bad = with_violations(staged, rules).where(F.size(VIOLATIONS) > 0)
    return staged.where(passes(rules)), bad

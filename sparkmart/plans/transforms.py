"""The four extracts, cleaned.

Each transform writes its deduplicated, complete rows once. The figures observed in that write
(row counts, NULLs, negatives) settle the sign rule for the rest of the plan, so the large
deduplication shuffle runs a single time per table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sparkmart.functions.dates import segment
from sparkmart.operators import cleaning
from sparkmart.operators.joins import lookup
from sparkmart.sources.extracts import Extract
from sparkmart.staging import Staging


@dataclass
class Cleaned:
    """Clean rows with what cleaning found out. staged are the complete rows as they were written;
    output is counted when it is first asked for, unless a pass over the rows has counted them."""

    rows: DataFrame
    input: int
    counted: int | None
    nulls: dict[str, int]
    negatives: dict[str, int]
    invalid_emails: int = 0
    staged: DataFrame | None = None

    @property
    def output(self) -> int:
        if self.counted is None:
            self.counted = self.rows.count()
        return self.counted

    @property
    def messages(self) -> list[str]:
        return [cleaning.negative_message(c, n) for c, n in self.negatives.items()]

    @property
    def warnings(self) -> list[str]:
        """What was dropped for missing values, or repaired."""
        found = [cleaning.null_message(c, n) for c, n in self.nulls.items() if n]
        return found + ([cleaning.email_message(self.invalid_emails)] if self.invalid_emails else [])

    @property
    def figures(self) -> dict[str, int]:
        """Counts of what was dropped or repaired, where there was something."""
        nulls = {f"nulls_{c}": n for c, n in self.nulls.items() if n}
        return nulls | ({"invalid_emails": self.invalid_emails} if self.invalid_emails else {})


def clean(extract: Extract, staging: Staging) -> Cleaned:
    """First row per key, then complete rows only, then the sign rule, in this order.

    Each kept row brings the number of its copies through the shuffle; their sum is the number of
    input rows, which so needs no pass of its own.
    """
    source = extract.source
    carried = extract.rows.drop(*extract.derived)
    first = cleaning.keep_first(carried, [source.key], extract.order_by, copies="_copies")
    columns = [extract.derived.get(c, F.col(c)).alias(c) for c in source.columns]
    complete = cleaning.present(source.required)
    figures = {
        "input": F.sum("_copies"),
        **cleaning.null_counts(source.required),
        **cleaning.sign_counts(source.non_negative, complete),
    }
    if "email" in source.columns:
        bad = complete & ~cleaning.has_at_sign(F.col("email"))
        figures["invalid_emails"] = F.count_if(bad)
    staged, seen = staging.write(
        first.select(*columns, "_copies"), f"{source.name}_clean", figures, keep=complete
    )
    negatives = cleaning.flagged_columns(source.non_negative, seen)
    nulls = {c: seen.get(f"nulls:{c}", 0) for c in source.required}
    rows = cleaning.keep_non_negative(staged.select(*source.columns), negatives)
    kept = cleaning.kept_rows(negatives, seen)
    emails = seen.get("invalid_emails") or 0
    return Cleaned(rows, seen.get("input") or 0, kept, nulls, negatives, emails, rows)


def transform_products(extract: Extract, as_of: dt.date, staging: Staging) -> Cleaned:
    result = clean(extract, staging)
    result.rows = result.rows.withColumns({"effective_date": F.lit(as_of), "is_current": F.lit(True)})
    return result


def transform_customers(extract: Extract, as_of: dt.date, staging: Staging) -> Cleaned:
    result = clean(extract, staging)
    repaired = cleaning.repair_email(result.rows)
    result.rows = repaired.withColumn("customer_segment", segment(F.col("registration_date"), as_of))
    return result


def transform_stores(extract: Extract, staging: Staging) -> Cleaned:
    return clean(extract, staging)


def with_measures(sales: DataFrame) -> DataFrame:
    """Revenue, cost and profit, exact and unrounded."""
    amounts = {
        "revenue": F.col("quantity") * F.col("price"),
        "cost": F.col("quantity") * F.col("unit_cost"),
    }
    return sales.withColumns(amounts).withColumn("profit", F.col("revenue") - F.col("cost"))


def transform_sales(
    extract: Extract, products: DataFrame, staging: Staging, carry: Sequence[str] = ()
) -> Cleaned:
    """Clean sales with measures; sales without a known unit cost are left out.

    carry names further product columns to bring along, such as the product key: one join on
    the product then serves both lookups.
    """
    result = clean(extract, staging)
    costs = products.select("product_id", "unit_cost", *carry)
    result.counted = None
    priced = lookup(result.rows, costs, "product_id", ["unit_cost", *carry], how="left")
    result.rows = with_measures(priced).where(F.col("unit_cost").isNotNull())
    return result

"""Text cells to typed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The texts that a CSV cell may hold to mean "no value".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_if_token(text: Column) -> Column:
    """NULL where the cell holds one of the null tokens."""
    return F.when(~text.isin(NULL_TOKENS), text)


def typed(text: Column, kind: str) -> Column:
    """The cell as its staging type, NULL where the text does not fit it."""
    if kind == "text":
        return text
    trimmed = F.trim(text)
    if kind == "date":
        return trimmed.try_cast("date")
    if kind == "money":
        return trimmed.try_cast("decimal(18,6)")
    # Whole numbers may be written as 12 or 12.0, as a nullable integer column often is.
    number = trimmed.try_cast("decimal(38,6)")
    whole = F.when(number == F.floor(number), number)
    return whole.try_cast("bigint" if kind == "id" else "int")

"""Every operator as a query over the test tables, next to the SQL that must agree with it."""

from checks import (  # noqa: F401  (each module registers its queries)
    aggregates, builders, cleaning, dirty, joins, quality, reporting, sources,
)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

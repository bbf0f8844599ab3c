"""SQL text with named parameters."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession

logger = logging.getLogger(__name__)

QUOTED_AMOUNT = re.compile(r"'%\((\w+)\)s (\w+)'")
PARAMETER = re.compile(r"%\((\w+)\)s")


def run_query(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Run SQL; parameters are written :name or %(name)s and bound as values.

    An interval may hold its amount as INTERVAL '%(days)s days'; the amount must be whole.
    """
    values = dict(params or {})
    text = QUOTED_AMOUNT.sub(lambda m: f"'{int(values[m[1]])} {m[2]}'", query)
    text = PARAMETER.sub(r":\1", text)
    try:
        return spark.sql(text, args=values)
    except Exception as error:
        logger.error("query failed: %s", error)
        raise

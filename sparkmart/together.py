"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, tasks: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run the tasks at the same time; small jobs then fill the cores that large ones leave.

    The first error is raised once all tasks are over. Threads inherit job group and tags.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(inherit(task)) for name, task in tasks.items()}
    return {name: future.result() for name, future in futures.items()}

"""What several operators share: reading a table, sending the package, Arrow batches cut by size."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()

ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark application.

    Rows are whole texts here, and Spark's batches of 10,000 rows would hold tens of megabytes on
    either side of each worker; where that default is in force, batches of 1,000 rows replace it.
    """
    if spark.conf.get(ROWS_PER_BATCH) == "10000":
        spark.conf.set(ROWS_PER_BATCH, "1000")
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        _SHIPPED.add(application)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        copy = os.path.join(tempfile.mkdtemp(), "code")
        shutil.copytree(package, os.path.join(copy, "sparkmart"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(copy, f"sparkmart-{application}"), "zip", copy, "sparkmart"))


#: Drops the shuffle files of a job when it is over, not when the driver's memory is next cleaned up.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shipping(function: Callable) -> Callable:
    """A function of (spark, ...) that first sees to it that the workers have this package, and whose
    jobs, up to the frame that it gives back, leave no shuffle files behind.

    The jobs are writes into the shared folder, each run once, so nothing needs those files again.
    The session's own setting holds again for whatever is done with the frame.
    """

    @wraps(function)
    def run(spark: SparkSession, *args, **kwargs):
        ship(spark)
        before = spark.conf.get(SHUFFLE_CLEANUP, None)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            found = function(spark, *args, **kwargs)
        finally:
            if before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)
        return found.select("*") if isinstance(found, DataFrame) else found  # a frame has the settings it was made under

    return run


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch, each with about most_bytes of text or a single row."""
    offsets, start, size = batch.column(column), 0, 0
    for row in range(batch.num_rows):
        size += len(offsets[row].as_buffer() or b"") if offsets[row].is_valid else 0
        if size >= most_bytes:
            yield batch.slice(start, row + 1 - start)
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def per_slice(
    df: DataFrame,
    text_col: str,
    schema: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> DataFrame:
    """Apply work to slices of the rows of df, inside the tasks and without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield work(part)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns; others, whatever their names, go no further."""
    return df.select(*[df[n] for n in names])

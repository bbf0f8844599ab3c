"""Session settings: a local session for tests and measurements, and sizes for a cluster."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

BYTES_PER_SHUFFLE_PARTITION = 512 * 1024**2
LEAST_SHUFFLE_PARTITIONS = 200

#: A task that sorts or merges rows gets about so much of stored input, which may be ten times as much
#: in memory, and about twice as much of compressed shuffle data.
BYTES_PER_SORT = 8 * 1024**2

_sized: dict[int, tuple[int, dict[str, str | None]]] = {}
_sizing = threading.Lock()


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for the size of the largest source.

    Runtime planning merges shuffle partitions that turn out small and splits skewed ones, but
    never makes more of them than it starts with; so it starts with enough.
    """
    partitions = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    return {
        "spark.sql.shuffle.partitions": str(max(partitions, LEAST_SHUFFLE_PARTITIONS)),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.session.timeZone": "UTC",
    }


def bytes_under(spark: SparkSession, path: str) -> int:
    """The size of all files under a path, from their listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def input_bytes(*frames: DataFrame) -> int:
    """The size of all files that the frames read; frames without files count nothing."""
    total = 0
    for name in {f for df in frames for f in df.inputFiles()}:
        jvm, hadoop = frames[0].sparkSession._jvm, frames[0].sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        total += path.getFileSystem(hadoop).getFileStatus(path).getLen()
    return total


def _bytes(spark: SparkSession, setting: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(setting))


@contextmanager
def sized(spark: SparkSession, *frames: DataFrame) -> Iterator[None]:
    """Inside, tasks are as many as the frames' files ask for, so that a task's rows fit its memory
    whatever the input: a session with a fixed number of shuffle partitions sorts more and more rows
    in each, and spills them. Partitions never become fewer or larger than the session has them.

    Only what runs inside is planned that way. Steps inside one another, also in other threads, share
    the settings of the first; the last to leave restores the session's.
    """
    session = spark._jsparkSession.hashCode()
    with _sizing:
        depth, before = _sized.get(session, (0, {}))
        if not depth:
            wanted = {
                "spark.sql.shuffle.partitions": max(
                    int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(*frames) // BYTES_PER_SORT)
                ),
                **{
                    s: min(_bytes(spark, s), 2 * BYTES_PER_SORT)
                    for s in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
                },
            }
            before = {s: spark.conf.get(s) for s in wanted}
            for setting, value in wanted.items():
                spark.conf.set(setting, str(value))
        _sized[session] = depth + 1, before
    try:
        yield
    finally:
        with _sizing:
            depth, before = _sized.pop(session)
            if depth > 1:
                _sized[session] = depth - 1, before
            else:
                for setting, value in before.items():
                    spark.conf.set(setting, value)


def local_session(cores: int = 8, memory: str = "16g", **conf: str) -> SparkSession:
    settings = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sparkmart")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

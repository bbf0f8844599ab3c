"""Intermediate results written as Parquet into the shared checkpoint folder.

A staged frame cuts the lineage: what reads it survives the loss of any executor, and nothing
upstream runs twice. Figures taken while staging are observed in the last stage of the write,
above every shuffle. Only there does Spark count each task once, however often tasks or map
stages are run again.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of their own
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sparkmart-"))
    return context.getCheckpointDir()


class Staging:
    """A fresh sub-folder of the shared folder, for one run."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{root or shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def drop(self) -> None:
        """Delete the folder, once nothing reads from it any more."""
        self._delete(self.folder)

    def discard(self, *names: str) -> None:
        """Delete what was written under these names, once nothing reads from it any more."""
        for name in names:
            self._delete(self.path(name))

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def write(
        self,
        df: DataFrame,
        name: str,
        figures: dict[str, Column] | None = None,
        keep: Column | None = None,
        columns: Sequence[str] | None = None,
    ) -> tuple[DataFrame, dict[str, int]]:
        """Write df once; give it back read from storage, with the observed figures.

        The figures are of all rows and columns. With keep, only the rows it is true for are
        written; with columns, only these.
        """
        observation = Observation()
        if figures:
            df = df.observe(observation, *[f.alias(n) for n, f in figures.items()])
        if keep is not None:
            df = df.where(keep)
        if columns is not None:
            df = df.select(*columns)
        path = self.path(name)
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        return staged, dict(observation.get) if figures else {}

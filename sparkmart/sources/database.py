"""Tables of a relational database over JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str = ""
    password: str = ""
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_environment(cls) -> Database:
        """The endpoint that DB_HOST, DB_PORT, DB_NAME, DB_USER and DB_PASSWORD name.

        The name and the user must be set.
        """
        missing = [v for v in ("DB_NAME", "DB_USER") if not os.getenv(v)]
        if missing:
            raise ValueError(f"set {' and '.join(missing)}")
        host = os.getenv("DB_HOST", "localhost")
        port = os.getenv("DB_PORT", "5432")
        return cls(
            url=f"jdbc:postgresql://{host}:{port}/{os.environ['DB_NAME']}",
            user=os.environ["DB_USER"],
            password=os.getenv("DB_PASSWORD", ""),
        )

    @property
    def options(self) -> dict[str, str]:
        named = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in named.items() if v}


def read_options(
    database: Database,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    one_task: bool = False,
) -> dict[str, str]:
    """Reader options. With a numeric or date column and its range, tasks read in parallel.

    A read of a whole table by one task must be asked for.
    """
    if not column and not one_task:
        raise ValueError(f"say how to split the read of {table}, or one_task=True")
    options = {**database.options, "dbtable": table, "fetchsize": str(fetch_size)}
    if column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, database: Database, table: str, **partitioning) -> DataFrame:
    """A table or a parenthesised query; filters and columns are pushed into the database."""
    return spark.read.format("jdbc").options(**read_options(database, table, **partitioning)).load()


def write_options(
    database: Database, table: str, connections: int, batch_size: int = 10_000
) -> dict[str, str]:
    """Writer options. The tasks that write at once are as many as the database is to bear; a
    full refresh empties the table instead of dropping it."""
    return {
        **database.options,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": "true",
    }


def write_table(
    df: DataFrame,
    database: Database,
    table: str,
    connections: int,
    mode: str = "append",
    batch_size: int = 10_000,
) -> None:
    """Append by column name, or replace all rows with mode overwrite."""
    writer = df.write.format("jdbc").options(**write_options(database, table, connections, batch_size))
    writer.mode(mode).save()

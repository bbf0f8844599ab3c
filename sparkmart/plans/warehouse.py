"""The star schema in the catalog: creation, refresh, append, compaction and views.

Every table is a list of segments, tables of their own that never change once they are published,
and one small view, the pointer, is the manifest: it names the segments of each table. A refresh
writes new segments beside the old ones, an append one more; either then replaces the pointer, for
all tables in one catalog operation, as its last step. Readers see the old rows or the new ones,
and a run that fails before that changes nothing. The segments published before stay for readers
that still use them; older ones go by age. compact() makes many segments one.

Nothing is added unchecked: refresh and append run the row rules, the uniqueness of keys and the
foreign keys of a table over the rows first. The rows are written once; keys are then counted and
looked up by themselves, and only where some are bad do whole rows meet them.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sparkmart.functions.dates import month_of_key
from sparkmart.operators.joins import absent_from
from sparkmart.operators.quality import (
    FAIL,
    VIOLATIONS,
    ConstraintViolation,
    broken,
    duplicate_keys,
    rule_counts,
    unmatched_keys,
)
from sparkmart.plans import reports
from sparkmart.schemas import DIM_DATE, FACT_SALES, FOREIGN_KEYS, TABLES, Table
from sparkmart.session import sized
from sparkmart.staging import Staging

POINTER = "published_versions"
KEEP_FOR = dt.timedelta(days=7)


class ConcurrentChange(RuntimeError):
    """Another run published a table while this one was at work on it."""


def new_version() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")


def with_load_columns(fact: DataFrame) -> DataFrame:
    """The fact with the time of its load and its partition, if it has none yet."""
    stamped = fact.withColumn("created_at", F.current_timestamp())
    return stamped if "date_month" in fact.columns else stamped.withColumn("date_month", month_of_key(F.col("date_key")))


def rejected_name(table: Table | str) -> str:
    return f"{table if isinstance(table, str) else table.name}_rejected"


class Warehouse:
    """A catalog database that holds the star schema as Parquet tables."""

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        location: str | None = None,
        keep_for: dt.timedelta = KEEP_FOR,
        staging: Staging | None = None,
    ):
        self.spark = spark
        self.database = database
        self.location = location
        self.keep_for = keep_for
        self._staging = staging

    @property
    def staging(self) -> Staging:
        self._staging = self._staging or Staging(self.spark)
        return self._staging

    def name(self, table: Table | str) -> str:
        return f"{self.database}.{table if isinstance(table, str) else table.name}"

    # -- creation ------------------------------------------------------------------------------

    def create_database(self) -> None:
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")

    def create_schema(self) -> None:
        """Make all five tables empty, in one step."""
        versions = {}
        for table in TABLES.values():
            versions[table.name] = f"{table.name}_v{new_version()}"
            layout = f" PARTITIONED BY ({table.partition_by})" if table.partition_by else ""
            self.spark.sql(
                f"CREATE TABLE {self.name(versions[table.name])} ({table.ddl}) USING parquet{layout}"
            )
        self.publish(versions)

    # -- segments ------------------------------------------------------------------------------

    def _manifest(self) -> dict[str, tuple[list[str], list[str]]]:
        """For each table the segments that are published and those that were so before."""
        if not self.spark.catalog.tableExists(self.name(POINTER)):
            return {}
        rows = self.spark.table(self.name(POINTER)).collect()  # one for each table
        return {r.table_name: (list(r.segments), list(r.previous)) for r in rows}

    def published(self) -> dict[str, list[str]]:
        """The segments of each table; read once for a consistent view of several."""
        return {t: now for t, (now, _) in self._manifest().items() if now}

    def publish(
        self,
        segments: Mapping[str, str | Sequence[str]],
        rejects_of: Iterable[str] = (),
        basis: Mapping[str, Sequence[str]] | None = None,
    ) -> None:
        """Make these segments (a single one may come as its name) the tables, in one catalog operation.

        rejects_of names the tables and sources whose rejected rows this run has settled: what is
        not among the segments has no rejected rows any more. basis tells what tables were when the
        run read them; if one is not that any more, nothing is published.
        """
        before = self.published()
        for table, read in (basis or {}).items():
            if before.get(table, []) != list(read):
                raise ConcurrentChange(f"{table} has changed since it was read")
        settled = {rejected_name(t) for t in rejects_of}
        new = {t: [s] if isinstance(s, str) else list(s) for t, s in segments.items()}
        now = {t: s for t, s in before.items() if t not in settled} | new
        rows = ", ".join(
            f"('{t}', {self._literal(now.get(t))}, {self._literal(before.get(t))})"
            for t in sorted(now.keys() | before.keys())
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(POINTER)} AS"
            f" SELECT * FROM VALUES {rows} AS t(table_name, segments, previous)"
        )
        self._drop_old()

    @staticmethod
    def _literal(segments: Sequence[str] | None) -> str:
        return f"CAST(array({', '.join(repr(s) for s in segments or ())}) AS ARRAY<STRING>)"

    def _drop_old(self) -> None:
        """Drop segments that are neither published nor were so last, once they are old enough
        not to be another run's that is still being written."""
        named = {s for lists in self._manifest().values() for listed in lists for s in listed}
        limit = (dt.datetime.now(dt.timezone.utc) - self.keep_for).strftime("%Y%m%d%H%M%S%f")
        for found in self.spark.sql(f"SHOW TABLES IN {self.database}").collect():
            age = re.fullmatch(r"\w+_v(\d{20})", found.tableName)
            if age and found.tableName not in named and age[1] < limit:
                self.drop_version(found.tableName)

    def drop_version(self, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")

    def _shaped(self, df: DataFrame, table: Table) -> DataFrame:
        """The table's columns, in order and rounded to its types."""
        return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in table.columns.items()])

    def write_version(
        self, df: DataFrame, table: Table, figures: dict[str, Column] | None = None,
        keep: Column | None = None,
    ) -> tuple[str, dict[str, int]]:
        """Write the rows as a new version, not visible yet; its name and the observed figures.

        The figures are of all rows; with keep, only the rows it is true for are written.
        """
        version = f"{table.name}_v{new_version()}"
        observation = Observation()
        if figures:
            df = df.observe(observation, *[f.alias(n) for n, f in figures.items()])
        if keep is not None:
            df = df.where(keep)
        writer = self._shaped(df, table).write.format("parquet")
        if table.partition_by:
            writer = writer.partitionBy(table.partition_by)
        writer.saveAsTable(self.name(version))
        return version, dict(observation.get) if figures else {}

    def write_rejected(self, rejected: DataFrame, name: str) -> tuple[str, int]:
        """Write rows that broke a rule as a version of their own; its name and their number."""
        version = f"{rejected_name(name)}_v{new_version()}"
        rejected.write.format("parquet").saveAsTable(self.name(version))
        return version, self.spark.table(self.name(version)).count()

    # -- constraints ---------------------------------------------------------------------------

    def existing_keys(self, table: Table, key: str, low: object, high: object) -> DataFrame:
        """The keys of a table from low to high. The bounds reach the scan, where the statistics of
        files and row groups leave out what lies outside: tables are sorted by their keys."""
        return self.table(table).select(key).where(F.col(key).between(F.lit(low), F.lit(high)))

    def _bad_keys(self, rows: DataFrame, table: Table, bounds: dict, against: bool) -> list[tuple[str, str, DataFrame]]:
        """(rule, column, values): the values that break a foreign key or a unique one, staged.

        Values are looked at without the rest of their rows: each once for foreign keys, counted for
        unique ones, and against the part of the table that the new keys' range leaves.
        """
        found = []

        def note(rule: str, column: str, values: DataFrame) -> None:
            name = f"{table.name}-{rule.replace(':', '-')}-{new_version()}"
            staged, seen = self.staging.write(values.select(column), name, {"n": F.count(F.lit(1))})
            if seen["n"]:
                found.append((rule, column, staged))

        for column, dimension in FOREIGN_KEYS.items() if table is FACT_SALES else ():
            note(f"foreign_key:{column}", column, unmatched_keys(rows, column, self.table(dimension)))
        for key in dict.fromkeys(k for k in (table.surrogate_key, table.natural_key) if k):
            values = duplicate_keys(rows, [key]).select(key)
            low, high = bounds[f"low:{key}"], bounds[f"high:{key}"]
            if against and low is not None:
                there = self.existing_keys(table, key, low, high)
                values = values.unionByName(there.join(rows.select(key), key, "left_semi")).distinct()
            note(f"unique:{key}", key, values)
        return found

    def checked(self, df: DataFrame, table: Table, against: bool = False) -> tuple[DataFrame, DataFrame | None]:
        """The rows, staged, and those of them that break constraints, if any do, with the names of
        all rules that each breaks: row rules, foreign keys without a row, keys that repeat (in the
        rows or, with against, in the table)."""
        keys = dict.fromkeys(k for k in (table.surrogate_key, table.natural_key) if k)
        bounds = {f"low:{k}": F.min(k) for k in keys} | {f"high:{k}": F.max(k) for k in keys}
        figures = rule_counts(table.rules) | bounds
        rows, seen = self.staging.write(df, f"{table.name}-checked-{new_version()}", figures)
        bad = self._bad_keys(rows, table, seen, against)
        if not bad and not any(seen[name] for name in rule_counts(table.rules)):
            return rows, None
        marked = rows
        flags = [F.when(broken(r), F.lit(r.name)) for r in table.rules]
        for rule, column, values in bad:  # one row per value: Spark may split a hot one of the rows
            flag = f"_{rule}"
            marked = marked.join(values.withColumn(flag, F.lit(True)), column, "left")
            flags.append(F.when(F.col(f"`{flag}`"), F.lit(rule)))
        return rows, marked.select(*rows.columns, F.array_compact(F.array(*flags)).alias(VIOLATIONS))

    def _sorted_out(
        self, df: DataFrame, table: Table, on_violation: str, against: bool = False
    ) -> tuple[DataFrame, DataFrame | None]:
        """Good rows and, with quarantine, bad ones; an error if there are any otherwise."""
        rows, marked = self.checked(df, table, against)
        if marked is None:
            return rows, None
        if on_violation == FAIL:
            rules = marked.select(F.explode(VIOLATIONS).alias("rule")).groupBy("rule").count().collect()
            raise ConstraintViolation(table.name, dict(sorted((r.rule, r["count"]) for r in rules)))
        return marked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), marked.where(F.size(VIOLATIONS) > 0)

    def refresh(self, df: DataFrame, table: Table, on_violation: str = FAIL) -> int:
        """Replace all rows by rows that keep the constraints; how many the table then holds."""
        with sized(self.spark, df):
            good, bad = self._sorted_out(df, table, on_violation)
            segments = {table.name: self.write_version(good, table)[0]}
            if bad is not None:
                segments[rejected_name(table)], _ = self.write_rejected(bad, table.name)
        self.publish(segments, [table.name])
        return self.count(table)

    def append(self, df: DataFrame, table: Table, on_violation: str = FAIL) -> int:
        """Add rows that keep the constraints, bound by column name; how many rows were set apart.

        The rows become one more segment. It and the rejected rows are published together; until
        then, and if anything fails, the table is what it was.
        """
        before = self._segments(table)
        count = 0
        with sized(self.spark, df, self._read(before)):
            good, bad = self._sorted_out(df, table, on_violation, against=True)
            version, seen = self.write_version(good, table, {"n": F.count(F.lit(1))})
            segments: dict[str, Sequence[str]] = {table.name: [*before, version]}
            if not seen["n"]:
                self.drop_version(version)
                segments[table.name] = before
            if bad is not None:
                rejected, count = self.write_rejected(bad, table.name)
                segments[rejected_name(table)] = [rejected]
        self.publish(segments, [table.name], {table.name: before})
        return count

    def compact(self, table: Table) -> int:
        """Write all segments of a table as one, in the order of its keys; how many there were."""
        before = self._segments(table)
        if len(before) > 1:
            order = [c for c in (table.partition_by, table.surrogate_key) if c]
            rows = self._read(before)
            with sized(self.spark, rows):
                whole = rows.repartitionByRange(*order).sortWithinPartitions(*order)
                version, _ = self.write_version(whole, table)
            self.publish({table.name: version}, basis={table.name: before})
        return len(before)

    # -- dates ---------------------------------------------------------------------------------

    def absent_dates(self, days: DataFrame) -> DataFrame:
        return absent_from(days, self.table(DIM_DATE), DIM_DATE.natural_key)

    def dates_with(self, days: DataFrame) -> DataFrame:
        """The date dimension as it will be once the days are added; days there stay as they are."""
        if DIM_DATE.name not in self.published():
            return days
        return self.table(DIM_DATE).unionByName(self.absent_dates(days))

    def add_dates(self, days: DataFrame) -> int:
        """Add the days that are not there yet; days that are there stay untouched."""
        self.append(self.absent_dates(days), DIM_DATE)
        return self.count(DIM_DATE)

    # -- reading -------------------------------------------------------------------------------

    def _read(self, segments: Sequence[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.table(self.name(s)) for s in segments])

    def _segments(self, table: Table | str) -> list[str]:
        name = table if isinstance(table, str) else table.name
        found = self.published().get(name)
        if not found:
            raise ValueError(f"{self.database} has no {name}")
        return found

    def tables(self) -> dict[str, DataFrame]:
        """All published tables, of one and the same switch."""
        return {t: self._read(segments) for t, segments in self.published().items()}

    def table(self, table: Table | str) -> DataFrame:
        return self._read(self._segments(table))

    def rejected(self, table: Table | str) -> DataFrame | None:
        """The rows that the last run or append set apart, if there are any."""
        return self.tables().get(rejected_name(table))

    def count(self, table: Table | str) -> int:
        """Rows now in the table; for Parquet, Spark reads no more than the file footers."""
        return self.table(table).count()

    def count_version(self, version: str) -> int:
        return self.spark.table(self.name(version)).count()

    def keys(self, table: Table) -> DataFrame:
        """Natural key and surrogate key of a dimension."""
        return self.table(table).select(table.natural_key, table.surrogate_key)

    def star(self) -> reports.Star:
        tables = self.tables()
        return reports.Star(
            sales=tables["fact_sales"],
            product=tables["dim_product"],
            customer=tables["dim_customer"],
            store=tables["dim_store"],
            date=tables["dim_date"],
        )

    def register_views(self) -> None:
        """The tables and the two views under their plain names, for SQL text."""
        tables = self.tables()
        for name in TABLES:
            tables[name].createOrReplaceTempView(name)
        star = self.star()
        reports.sales_summary(star).createOrReplaceTempView("vw_sales_summary")
        reports.monthly_revenue(star).createOrReplaceTempView("vw_monthly_revenue")

"""Build the warehouse from a folder of CSV extracts; write and print the run's figures and reports.

    spark-submit --py-files sparkmart.zip -m sparkmart FOLDER   (or: python -m sparkmart FOLDER)

Every report is written in full to a table of the database, report_<name>, and printed in full as
tab-separated lines, row by row.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession

from sparkmart.operators.quality import FAIL, QUARANTINE
from sparkmart.plans import reports
from sparkmart.plans.build import build_from_csv
from sparkmart.session import bytes_under, cluster_settings


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sparkmart", description="Build a retail star schema.")
    parser.add_argument("folder", help="holds sales.csv, customers.csv, products.csv, stores.csv")
    parser.add_argument("--database", default="retail")
    parser.add_argument("--location", help="folder of the database")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--on-violation", choices=[FAIL, QUARANTINE], default=FAIL)
    return parser.parse_args(argv)


def print_rows(name: str, rows: DataFrame) -> None:
    """All rows, one at a time, below their number and the columns' names."""
    print(f"\n{name}: {rows.count()} rows")
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("sparkmart").getOrCreate()
    for key, value in cluster_settings(bytes_under(spark, options.folder)).items():
        spark.conf.set(key, value)
    run = build_from_csv(
        spark, options.folder, options.database, options.as_of, options.on_violation, options.location
    )
    print_rows("run", run.summary_frame())
    for name, report in reports.full_report(run.warehouse.star(), options.as_of).items():
        stored = run.warehouse.name(f"report_{name}")
        report.write.mode("overwrite").saveAsTable(stored)
        print_rows(name, report)


if __name__ == "__main__":
    main()

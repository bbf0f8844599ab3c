from __future__ import annotations

import datetime as dt
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmart.plans.build import StarBuild  # noqa: E402
from sparkmart.plans.warehouse import Warehouse  # noqa: E402
from sparkmart.schemas import SOURCES  # noqa: E402
from sparkmart.session import local_session  # noqa: E402
from sparkmart.sources import driver_tables  # noqa: E402
from sparkmart.sources.extracts import extract_all, frame_extract  # noqa: E402
from sparkmart.staging import Staging  # noqa: E402

TABLES = "/root/testdata/sf0.001"
AS_OF = dt.date(2026, 3, 10)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        4, "4g", **{"spark.checkpoint.dir": str(shared), "spark.sql.shuffle.partitions": "2"}
    )
    yield session
    session.stop()


@pytest.fixture
def staging(spark, tmp_path):
    return Staging(spark, str(tmp_path))


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"mart_{uuid.uuid4().hex[:8]}", location=str(tmp_path / "warehouse"))


@pytest.fixture
def extract(spark):
    """Make an extract from rows given as tuples, in this order."""

    def make(name, rows):
        source = SOURCES[name]
        fields = ", ".join(f"{c} {source.staging_type(c)}" for c in source.columns)
        numbered = [(*r, i) for i, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"{fields}, position INT")
        return frame_extract(df, source, ("position",))

    return make


@pytest.fixture(scope="session")
def csv_folder(spark, tmp_path_factory):
    """The smallest test tables as four CSV extracts of several files, first rows first."""
    folder = tmp_path_factory.mktemp("extracts")
    for name, extract in driver_tables.extracts(spark, TABLES).items():
        path = str(folder / SOURCES[name].file)
        ordered = extract.rows.repartitionByRange(3, *extract.order_by)
        in_files = ordered.sortWithinPartitions(*extract.order_by).select(*extract.source.columns)
        in_files.write.options(header=True, escape='"').csv(path)
    return str(folder)


@pytest.fixture(scope="session")
def small_build(spark, csv_folder, tmp_path_factory):
    """The star of these extracts."""
    folder = tmp_path_factory.mktemp("small")
    warehouse = Warehouse(spark, f"mart_{uuid.uuid4().hex[:8]}", location=str(folder / "mart"))
    return StarBuild(
        extract_all(spark, csv_folder),
        warehouse,
        driver_tables.AS_OF,
        driver_tables.DATE_RANGE,
        staging=Staging(spark, str(folder)),
    ).run()

"""The whole star build: extract, transform, load, with figures of every step.

All tables, the rejected rows among them, are checked, written and counted first and then
switched in one step, the last of a run; a run that fails leaves the warehouse as it was. All
staged data is in the shared folder, from which a run that is over takes it away; a lost executor
costs the tasks it ran, not the run.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.operators.keys import number_rows, stage_in_order
from sparkmart.operators.quality import (
    FAIL, QUARANTINE, VIOLATIONS, ConstraintViolation, broken_rules, enforce, passes, rule_counts,
    with_violations,
)
from sparkmart.plans import facts, transforms
from sparkmart.plans.calendar import date_dimension
from sparkmart.plans.warehouse import Warehouse, rejected_name, with_load_columns
from sparkmart.schemas import (
    DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_STORE, FACT_SALES, TABLES, Table,
)
from sparkmart.session import sized
from sparkmart.sources.extracts import Extract, extract_all
from sparkmart.staging import Staging
from sparkmart.together import together

logger = logging.getLogger(__name__)

DAYS_BACK, DAYS_AHEAD = 120, 30

SOURCE_OF = {
    "dim_product": "products",
    "dim_customer": "customers",
    "dim_store": "stores",
    "fact_sales": "sales",
}


class StarBuild:
    """One run over four extracts into one warehouse."""

    def __init__(
        self,
        extracts: dict[str, Extract],
        warehouse: Warehouse,
        as_of: dt.date | None = None,
        date_range: tuple[dt.date, dt.date] | None = None,
        on_violation: str = FAIL,
        staging: Staging | None = None,
        keep_staged: bool = False,
    ):
        self.extracts = extracts
        self.warehouse = warehouse
        self.as_of = as_of or dt.date.today()
        self.date_range = date_range or (
            self.as_of - dt.timedelta(days=DAYS_BACK),
            self.as_of + dt.timedelta(days=DAYS_AHEAD),
        )
        self.on_violation = on_violation
        self.staging = staging or Staging(warehouse.spark)
        self.keep_staged = keep_staged
        self.cleaned: dict[str, transforms.Cleaned] = {}
        self.status = "NOT_STARTED"
        self.start_time: dt.datetime | None = None
        self.end_time: dt.datetime | None = None
        self.stats: dict[str, dict[str, dict[str, int]]] = {
            "extract": {}, "transform": {}, "load": {},
        }
        self._keyed: dict[str, DataFrame] = {}
        self._rejected: dict[str, DataFrame] = {}

    # -- steps ---------------------------------------------------------------------------------

    def extract(self) -> None:
        """Set unreadable rows apart, reading their source once. Other records are counted as the
        transforms read them."""
        for name, extract in self.extracts.items():
            self.extracts[name], unreadable = extract.parted(self.staging)
            if unreadable:
                self._rejected[name] = self.extracts[name].unreadable
            self.stats["extract"][name] = {
                "records": unreadable, "columns": len(extract.source.columns),
            }

    def transform(self) -> None:
        """Clean, check and key the dimensions, and clean the sales."""
        done = together(
            self.warehouse.spark,
            {
                "customers": self._prepare_customers,
                "stores": self._prepare_stores,
                "products": self._prepare_products_and_sales,
            },
        )
        products, sales = done["products"]
        self.cleaned = {
            "products": products,
            "customers": done["customers"],
            "stores": done["stores"],
            "sales": sales,
        }
        for name, cleaned in self.cleaned.items():
            self.stats["extract"][name]["records"] += cleaned.input
            for warning in cleaned.warnings:
                logger.warning("%s: %s", name, warning)
            if cleaned.counted is not None:
                self._count(name)

    def _count(self, name: str) -> None:
        cleaned = self.cleaned[name]
        self.stats["transform"][name] = {
            "input_records": cleaned.input,
            "output_records": cleaned.output,
            "removed_records": cleaned.input - cleaned.output,
            **cleaned.figures,
        }

    def _prepare_customers(self) -> transforms.Cleaned:
        customers = transforms.transform_customers(
            self.extracts["customers"], self.as_of, self.staging
        )
        self._stage_dimension(customers.rows, DIM_CUSTOMER)
        return customers

    def _prepare_stores(self) -> transforms.Cleaned:
        stores = transforms.transform_stores(self.extracts["stores"], self.staging)
        self._stage_dimension(stores.rows, DIM_STORE)
        return stores

    def _prepare_products_and_sales(self) -> tuple[transforms.Cleaned, transforms.Cleaned]:
        """Sales look up the cost and the key of their product in one join."""
        products = transforms.transform_products(
            self.extracts["products"], self.as_of, self.staging
        )
        self._stage_dimension(products.rows, DIM_PRODUCT)
        costs = self._keyed["dim_product"].select("product_id", "unit_cost", "product_key")
        if "dim_product" in self._rejected:
            # Rejected products have a cost but no key: their sales count as clean, then drop out.
            keyless = F.lit(None).cast("bigint").alias("product_key")
            rejected = self._rejected["dim_product"].select("product_id", "unit_cost", keyless)
            costs = costs.unionByName(rejected)
        sales = transforms.transform_sales(
            self.extracts["sales"], costs, self.staging, carry=["product_key"]
        )
        return products, sales

    def _stage_dimension(self, df: DataFrame, table: Table) -> None:
        """Check, order and number the rows of a dimension, and write them, unrounded; being
        stored, their size is known to lookups."""
        order_by = [table.natural_key]
        if self.on_violation == QUARANTINE:
            df, rejected = enforce(df, table.rules, self.staging, f"{table.name}_checked", QUARANTINE)
            if rejected is not None:
                self._rejected[table.name] = rejected
            staged, _ = stage_in_order(df, order_by, self.staging, table.name)
        else:
            counts = rule_counts(table.rules)
            staged, figures = stage_in_order(df, order_by, self.staging, table.name, counts)
            self._must_hold(table, figures)
        keyed = number_rows(staged, table.surrogate_key)
        self._keyed[table.name], _ = self.staging.write(keyed, f"{table.name}_keyed")

    @staticmethod
    def _must_hold(table: Table, figures: dict[str, int]) -> None:
        counts = broken_rules(figures)
        if counts:
            raise ConstraintViolation(table.name, counts)

    def _write_fact(self, dims: facts.Dimensions) -> str:
        """Write the fact, once, as its new version. Its rules are observed in that write."""
        sales = self.cleaned["sales"]
        inputs = facts.fact_inputs(sales.rows, dims)
        rows = facts.with_fact_measures(facts.in_order(inputs, sales.staged, dims, sales.output))
        quarantine = self.on_violation == QUARANTINE
        version, figures = self.warehouse.write_version(
            with_load_columns(rows), FACT_SALES, rule_counts(FACT_SALES.rules), passes(FACT_SALES.rules)
        )
        counts = broken_rules(figures)
        if counts and quarantine:
            marked = with_violations(facts.with_fact_measures(inputs), FACT_SALES.rules)
            self._rejected[FACT_SALES.name] = marked.where(F.size(VIOLATIONS) > 0)
        elif counts:
            self.warehouse.drop_version(version)
            raise ConstraintViolation(FACT_SALES.name, counts)
        return version

    def load(self) -> None:
        warehouse, load = self.warehouse, self.stats["load"]
        warehouse.create_database()
        days = date_dimension(warehouse.spark, *self.date_range)
        dates, figures = self.staging.write(
            warehouse.dates_with(days), "dim_date", rule_counts(DIM_DATE.rules)
        )
        self._must_hold(DIM_DATE, figures)
        dims = facts.Dimensions(
            product=self._keyed["dim_product"],
            customer=self._keyed["dim_customer"],
            store=self._keyed["dim_store"],
            date=dates,
        )
        sales = self.cleaned["sales"]
        found = facts.lookup_figures(sales.rows, dims).first().asDict()
        sales.counted = found.pop("sales")
        self._count("sales")
        versions = together(
            warehouse.spark,
            {
                DIM_DATE.name: lambda: warehouse.write_version(dates, DIM_DATE)[0],
                DIM_PRODUCT.name: lambda: warehouse.write_version(dims.product, DIM_PRODUCT)[0],
                DIM_CUSTOMER.name: lambda: warehouse.write_version(dims.customer, DIM_CUSTOMER)[0],
                DIM_STORE.name: lambda: warehouse.write_version(dims.store, DIM_STORE)[0],
                FACT_SALES.name: lambda: self._write_fact(dims),
            },
        )
        for table, version in versions.items():
            load[table] = {"records_inserted": warehouse.count_version(version)}
            if table in SOURCE_OF:
                load[table]["records_source"] = self.cleaned[SOURCE_OF[table]].output
        if load["fact_sales"]["records_inserted"] < sales.output:
            load["fact_sales"] |= {f"unresolved_{lookup}": n for lookup, n in found.items()}
        for name, rejected in self._rejected.items():
            versions[rejected_name(name)], count = warehouse.write_rejected(rejected, name)
            load[rejected_name(name)] = {"records_inserted": count}
        # All rows are checked, written and counted; the warehouse changes here and nowhere else.
        warehouse.publish(versions, [*TABLES, *self.extracts])

    def run(self) -> StarBuild:
        self.start_time = dt.datetime.now()
        self.status = "RUNNING"
        try:
            with sized(self.warehouse.spark, *[e.rows for e in self.extracts.values()]):
                self.extract()
                self.transform()
                self.load()
            self.status = "SUCCESS"
            if not self.keep_staged:
                self.staging.drop()
        except Exception:
            self.status = "FAILED"
            logger.exception("the star build failed")
            raise
        finally:
            self.end_time = dt.datetime.now()
            logger.info("%s in %d s: %s", self.status, self.duration_seconds, self.stats)
        return self

    # -- figures -------------------------------------------------------------------------------

    @property
    def duration_seconds(self) -> int:
        if self.start_time is None or self.end_time is None:
            return 0
        return int((self.end_time - self.start_time).total_seconds())

    @property
    def validation_errors(self) -> list[dict[str, object]]:
        """What the sign rule removed, in the order it was found."""
        return [
            {"table_name": name, "column_name": column, "negatives": count, "message": message}
            for name, cleaned in self.cleaned.items()
            for (column, count), message in zip(cleaned.negatives.items(), cleaned.messages)
        ]

    def validation_frame(self) -> DataFrame:
        rows = [tuple(e.values()) for e in self.validation_errors]
        return self.warehouse.spark.createDataFrame(
            rows, "table_name STRING, column_name STRING, negatives BIGINT, message STRING"
        )

    def stats_frame(self, *stages: str) -> DataFrame:
        """The figures in long form: stage, table_name, metric, value."""
        rows = [
            (stage, table, metric, value)
            for stage, tables in self.stats.items()
            if not stages or stage in stages
            for table, metrics in tables.items()
            for metric, value in metrics.items()
        ]
        return self.warehouse.spark.createDataFrame(
            rows, "stage STRING, table_name STRING, metric STRING, value BIGINT"
        )

    def summary_frame(self) -> DataFrame:
        """Status, times and duration of the run as text, above the figures."""
        facts_of_run = {
            "status": self.status,
            "start_time": str(self.start_time),
            "end_time": str(self.end_time),
            "duration_seconds": str(self.duration_seconds),
        }
        head = self.warehouse.spark.createDataFrame(
            [("run", "", k, v) for k, v in facts_of_run.items()],
            "stage STRING, table_name STRING, metric STRING, value STRING",
        )
        figures = self.stats_frame().withColumn("value", F.col("value").cast("string"))
        return head.unionByName(figures)


def build_from_csv(
    spark: SparkSession,
    folder: str,
    database: str,
    as_of: dt.date | None = None,
    on_violation: str = FAIL,
    location: str | None = None,
) -> StarBuild:
    """Read the four CSV extracts of a folder and refresh the warehouse from them."""
    extracts = extract_all(spark, folder, on_unreadable=on_violation)
    return StarBuild(extracts, Warehouse(spark, database, location), as_of, on_violation=on_violation).run()

"""Readers for the four extracts.

Every reader gives an Extract: a lazy frame in staging types plus the columns that say which row
came first. Row order is (file, block start, row id): the row id alone follows Spark's packing of
splits into tasks, not the files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkmart.functions.parse import null_if_token, typed
from sparkmart.operators.quality import FAIL
from sparkmart.schemas import SOURCES, Source
from sparkmart.staging import Staging
from sparkmart.together import together

INGEST_ORDER = ("_file", "_block", "_row")
UNREADABLE = "_unreadable"
_EXTRA, _ODD = "_extra", "_odd"


@dataclass(frozen=True)
class Extract:
    source: Source
    rows: DataFrame
    order_by: tuple[str, ...]
    path: str = ""
    marked: DataFrame | None = None
    #: Source columns that follow from columns of the row order: these need not travel with them.
    derived: Mapping[str, Column] = field(default_factory=dict)

    @property
    def unreadable(self) -> DataFrame | None:
        """Rows set apart, as text, with the names of the cells that cannot be read."""
        return None if self.marked is None else self.marked.where(F.size(UNREADABLE) > 0)

    def parted(self, staging: Staging) -> tuple[Extract, int]:
        """The same extract with readable and unreadable rows read from one staged copy, so that
        the source is read once; and the number of the latter."""
        if self.marked is None:
            return self, 0
        counted = {"unreadable": F.count_if(F.size(UNREADABLE) > 0)}
        staged, seen = staging.write(self.marked, f"{self.source.name}_marked", counted)
        return _readable(self.source, staged, self.path), seen["unreadable"]

    @property
    def data(self) -> DataFrame:
        """The source's own columns, without the order columns."""
        return self.rows.select(*self.source.columns)


def with_ingest_order(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def read_csv_text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header CSV as text columns named by the header, with the ingest order.

    Rows shorter than the header are filled with NULL; a longer row stops the job. Each file's
    header is compared with the first one's in the task that reads it: a file with other columns,
    or the same in another order, stops the job with its name.
    """
    settings = {"header": True, "escape": '"', **options}
    names = spark.read.options(**settings).csv(path).columns
    fields = [f"`{n}` STRING" for n in names]
    strict = {**settings, "enforceSchema": False, "columnNameOfCorruptRecord": _ODD}
    rows = with_ingest_order(
        spark.read.options(**strict).schema(", ".join([*fields, f"{_ODD} STRING"])).csv(path)
    )
    # A row of another length is kept as text as well; read again with one more column, it is long.
    again = {k: str(v) for k, v in options.items()} | {"escape": settings["escape"]}
    wider = F.from_csv(F.col(_ODD), ", ".join([*fields, f"{_EXTRA} STRING"]), again)
    first = F.coalesce(F.col(f"`{names[0]}`"), F.lit("")) if names else F.lit("")
    too_long = F.concat(F.lit("more cells than header columns in "), F.col("_file"), F.lit(" at "), first)
    fits = F.when(F.col(_ODD).isNull() | wider[_EXTRA].isNull(), F.lit(True)).otherwise(
        F.raise_error(too_long).cast("boolean")
    )
    return rows.where(fits).drop(_ODD)


def check_columns(df: DataFrame, source: Source) -> None:
    missing = [c for c in (source.key, *source.required) if c not in df.columns]
    if missing:
        raise ValueError(f"{source.name} lacks required columns: {', '.join(missing)}")


def _value_or_error(text: Column, value: Column, name: str, kind: str) -> Column:
    problem = F.concat(F.lit(f"{name} cannot be read as {kind}: "), text)
    unreadable = text.isNotNull() & value.isNull()
    return F.when(unreadable, F.raise_error(problem).cast(kind)).otherwise(value)


def csv_extract(
    spark: SparkSession, path: str, source: Source, on_unreadable: str = FAIL, **options
) -> Extract:
    """A CSV file in staging types; columns are bound by name.

    A cell whose text does not fit its type stops the job, or, with quarantine, sets its whole
    row apart as text together with the names of such columns.
    """
    raw = read_csv_text(spark, path, **options)
    check_columns(raw, source)
    text = _cell_texts(raw, source)
    values = {c: typed(text[c], kind) for c, kind in source.columns.items()}
    if on_unreadable == FAIL:
        cells = [
            _value_or_error(text[c], values[c], c, source.staging_type(c)).alias(c)
            for c in source.columns
        ]
        rows = raw.select(*cells, *INGEST_ORDER)
    else:
        names = F.array_compact(
            F.array(
                *[
                    F.when(text[c].isNotNull() & values[c].isNull(), F.lit(c))
                    for c in source.columns
                ]
            )
        )
        return _readable(source, raw.withColumn(UNREADABLE, names), path)
    return Extract(source, rows, INGEST_ORDER, path)


def _cell_texts(df: DataFrame, source: Source) -> dict[str, Column]:
    return {
        c: null_if_token(F.col(c)) if c in df.columns else F.lit(None).cast("string")
        for c in source.columns
    }


def _readable(source: Source, marked: DataFrame, path: str) -> Extract:
    """The extract of rows whose unreadable cells have been named."""
    texts = _cell_texts(marked, source)
    cells = [typed(texts[c], kind).alias(c) for c, kind in source.columns.items()]
    rows = marked.where(F.size(UNREADABLE) == 0).select(*cells, *INGEST_ORDER)
    return Extract(source, rows, INGEST_ORDER, path, marked)


def parquet_extract(spark: SparkSession, path: str, source: Source) -> Extract:
    """Parquet files whose columns bear the source's names."""
    return replace(
        frame_extract(with_ingest_order(spark.read.parquet(path)), source, INGEST_ORDER),
        path=path,
    )


def frame_extract(
    df: DataFrame, source: Source, order_by: Sequence[str], made_of: Mapping[str, str] | None = None
) -> Extract:
    """Any frame, such as a catalog table or a database table, with a stated row order.

    made_of names the source columns that are plain copies of columns of that order.
    """
    check_columns(df, source)
    cells = [
        (F.col(c) if c in df.columns else F.lit(None)).cast(source.staging_type(c)).alias(c)
        for c in source.columns
    ]
    order = [F.col(c) for c in order_by if c not in source.columns]
    derived = {c: F.col(o).cast(source.staging_type(c)) for c, o in (made_of or {}).items()}
    return Extract(source, df.select(*cells, *order), tuple(order_by), derived=derived)


def extract_all(
    spark: SparkSession, folder: str, on_unreadable: str = FAIL, **options
) -> dict[str, Extract]:
    """The four CSV extracts of a folder, by source name."""
    return {
        name: csv_extract(spark, f"{folder}/{source.file}", source, on_unreadable, **options)
        for name, source in SOURCES.items()
    }


def extraction_stats(
    spark: SparkSession, extracts: dict[str, Extract]
) -> dict[str, dict[str, int | str]]:
    """Records, columns and path per source, by a count that reads no more than it must."""
    records = together(spark, {name: e.rows.count for name, e in extracts.items()})
    return {
        name: {
            "records": records[name],
            "columns": len(e.source.columns),
            "file_path": e.path,
        }
        for name, e in extracts.items()
    }

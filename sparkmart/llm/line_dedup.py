"""Site-relative line frequency: drop the lines that too many pages of a host share.

Per host, the pages containing a line (each page counted once) are divided by the host's pages.
Lines above the ratio are boilerplate and go from every page of that host. Only DataFrame
functions: what is shuffled are pairs of 64-bit hashes of lines, summed per task before they
move, so that a common line or a large host arrives as one row per task. Texts are not shuffled
unless the boilerplate is too large to broadcast.

Lines end at \\n and are compared without the spaces and tabs around them; blank lines are never
boilerplate. A null text stays null and counts as a page without lines; null hosts are one host.
A page is a row: repeated rows are pages of their own. A page of which nothing but blank lines
would be left can be kept whole (keep_emptied): such pages are copies of each other, which is for
near-duplicate detection to judge. A line whose share is just the ratio stays; equal lines of a host
share one fate, so there are no ties. A very long text is a page with many lines, or one long one.
An empty table gives an empty one; extra columns pass through, whatever their names, but for those
that are added, which begin with an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.staging import Staging

#: Up to so many boilerplate lines (16 bytes of hash each, in a list for each host) are broadcast.
BROADCAST_LINES = 250_000


@dataclass(frozen=True)
class BoilerplateRules:
    """A line goes if it is on more than ratio of a host's pages, and on min_pages at least."""

    ratio: float = 0.1
    min_pages: int = 5


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; the empty text where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def line_key(line: Column) -> Column:
    """A line's identity: two independent 64-bit hashes; null for a blank line."""
    bare = F.trim(line, F.lit(" \t\r"))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(17), bare).alias("b")))


def line_keys(text: Column) -> Column:
    """The distinct keys of a text's lines."""
    return F.array_compact(F.array_distinct(F.transform(F.split(text, "\n"), line_key)))


def boilerplate(pages: DataFrame, host: Column, text: Column, rules: BoilerplateRules) -> DataFrame:
    """(host, lines): the keys of the boilerplate lines of each host that has some."""
    slim = pages.select(host.alias("host"), text.alias("text"))
    totals = slim.groupBy("host").agg(F.count("*").alias("n_pages"))
    counts = (
        slim.select("host", F.explode(line_keys(F.col("text"))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n_with"))
        .where(F.col("n_with") >= rules.min_pages)
    )
    totals = totals.withColumnRenamed("host", "of_host")
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("of_host")))
        .where(F.col("n_with") > F.lit(rules.ratio) * F.col("n_pages"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("lines"))
    )


def drop_boilerplate(
    pages: DataFrame,
    host: Column,
    text_col: str = "text",
    rules: BoilerplateRules = BoilerplateRules(),
    keep_emptied: bool = False,
    staging: Staging | None = None,
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """pages with the boilerplate lines taken out of the text column, plus _n_lines and _n_dropped.

    A host's list is short: its lines are each on more than ratio of its pages, so it has at most
    (distinct lines per page) / ratio of them. Their number over all hosts is counted; above
    broadcast_lines the lists go to the pages by a shuffled join, in which Spark splits large hosts.
    """
    staging = staging or Staging(pages.sparkSession)
    lists, seen = staging.write(
        boilerplate(pages, host, F.col(text_col), rules),
        "boilerplate",
        {"lines": F.coalesce(F.sum(F.size("lines")), F.lit(0))},
    )
    if seen["lines"] <= broadcast_lines:
        lists = F.broadcast(lists)
    rows = pages.select(F.struct("*").alias("row"), host.alias("of_host"), F.split(F.col(text_col), "\n").alias("every"))
    joined = rows.join(lists, F.col("of_host").eqNullSafe(F.col("host")), "left")
    dropped = F.filter("every", lambda x: F.coalesce(F.array_contains(F.col("lines"), line_key(x)), F.lit(False)))
    left = F.filter("every", lambda x: ~F.coalesce(F.array_contains(F.col("lines"), line_key(x)), F.lit(False)))
    cut = joined.withColumn("n_dropped", F.when(F.col("lines").isNull(), 0).otherwise(F.coalesce(F.size(dropped), F.lit(0))))
    if keep_emptied:
        content = F.exists(left, lambda x: line_key(x).isNotNull())
        cut = cut.withColumn("n_dropped", F.when((F.col("n_dropped") > 0) & ~content, 0).otherwise(F.col("n_dropped")))
    text = F.when(F.col("n_dropped") > 0, F.array_join(left, "\n")).otherwise(F.col("row")[text_col])
    return cut.select(
        *[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in pages.columns],
        F.coalesce(F.size("every"), F.lit(0)).cast("long").alias("_n_lines"),
        F.col("n_dropped").cast("long").alias("_n_dropped"),
    )

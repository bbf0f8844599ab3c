"""A pretraining corpus from the documents: five stages, each the next one's input.

Null and empty texts fail the quality rules and go there. Repeated rows are kept up to the stage of
near-duplicates, where one of them stays; of texts of a class the one with the smallest id does, of
equal ids the smaller text key. Very long texts are rows like others, cut into sequences at the end.
Columns beyond those of documents pass through up to the last stage, whatever their names. Empty
tables give empty results. What each stage does in such cases is stated in its operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import line_dedup, order_minhash, quality_rules
from sparkmart.llm.common import ship, shipping, table
from sparkmart.llm.decontaminate_shuffled import decontaminator
from sparkmart.llm.queries import packed
from sparkmart.staging import Staging


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too many documents of a source share go. A document that has no other lines
    stays as it is: whether it is a copy is for the next stage to say."""
    cut = line_dedup.drop_boilerplate(docs, F.col("source"), keep_emptied=True).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that with the smallest id."""
    return order_minhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    return decontaminator(table(spark, sf_dir, "benchmark")).clean(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenized and packed into sequences."""
    return packed(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", shipping(quality)),
    ("line dedup", shipping(lines)),
    ("near-duplicates", shipping(near_duplicates)),
    ("decontamination", shipping(decontaminated)),
    ("packing", shipping(packing)),
]

#: Near-duplicate classes and best-fit packing can't be stated in SQL; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    ship(spark)
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs, _ = staging.write(stage(spark, docs, sf_dir), f"stage-{k}")
        staging.discard(f"stage-{k - 1}")  # the next stage has read it
    return docs

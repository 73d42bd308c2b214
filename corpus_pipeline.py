"""The corpus pipeline: documents through quality rules, line dedup, near-dedup,
benchmark decontamination and source mixing.

Each stage works on all that its predecessor kept, which is written as Parquet
and read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstar.llm import decontaminate, line_dedup, mixing, near_dedup, quality_rules
from loomstar.llm.shared import saved, table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned ones reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing is left; ``n_chars`` follows the text."""
    rows = line_dedup.keep_first_lines(docs)
    return rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and epoch taken."""
    return mixing.mixed(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Rules learned from labels and components of sketched sets have no SQL form:
#: tests/llm holds every stage against a brute-force version.
ORACLE_SQL = None

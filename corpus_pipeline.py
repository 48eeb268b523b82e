"""A corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablegate.llm import decontaminate, lines, mixing, quality, simhash
from tablegate.session import _remove, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do lines that too many documents of a source share."""
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier one go, and documents that have no word left."""
    return lines.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics reach their targets."""
    return mixing.sampled(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
]

# SimHash's majority bits and the raked sampling cannot be said in SQL; the stages are
# tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages; each stage's result is written and read again.

    A stage's result is dropped when the next one is written, also when that fails; the last
    one stays, as it is what is returned.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        try:
            stage(spark, docs, sf_dir).write.parquet(path)
        finally:
            if before is not None:
                _remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs

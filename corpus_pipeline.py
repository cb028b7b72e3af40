"""Corpus pipeline: quality rules, line dedup, n-gram Jaccard join, substring dedup, packing.

Each stage reads the Parquet that the one before it wrote.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forgeline.llm import catalog
from forgeline.session import drop_scratch, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    from forgeline.llm.quality_rules import keep_good

    catalog.small_batches(spark)
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines."""
    from forgeline.llm.line_templates import without_recurring_lines

    catalog.small_batches(spark)
    return without_recurring_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    from forgeline.llm.ngram_join import one_of_each

    catalog.small_batches(spark)
    return one_of_each(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    from forgeline.llm.substring_dedup import without_repeats

    catalog.small_batches(spark)
    return without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length token sequences."""
    from forgeline.llm.packing import pack

    catalog.small_batches(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", passage_stage),
    ("packing", packing_stage),
]

#: Tokenization has no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = catalog.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            drop_scratch(spark, last)  # read by no later stage
        last = path
    return docs

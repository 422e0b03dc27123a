"""The corpus pipeline: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet and reads it again as the next one's documents.
All stages but the last return the columns of ``documents``.

Rows are told apart by id and text: each stage decides by both, so null and
repeated ids are as good as any, and rows that repeat both stay or go together
(but for exact dedup, which leaves one).  Null and empty texts are neutral to
the first stage, one group of the second, near nothing in the third, clean in
the fourth and one closing id in the last.  Ties go to the id that the stage
names.  Empty tables give empty results; texts are read whole; columns that
``documents`` has besides id and text pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltaweave.llm import decontam, exact_dedup, minhash_dedup, quality
from voltaweave.llm.common import written
from voltaweave.llm.queries import packed, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good ones keeps."""
    return quality.select(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, the one with the smallest id."""
    return minhash_dedup.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document, all of power-of-two lengths."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("minhash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Weights, components and token ids have no DuckDB SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

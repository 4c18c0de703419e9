"""A training corpus from ``documents``: quality, near-duplicates, decontamination, mixing, shards.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All of them keep the columns
of ``docs``, whatever their names, give an empty table for an empty one, and treat a null text as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from debutrank.llm import decontam, mixing, near_dup, quality, sharding
from debutrank.session import written

SHARDS = 8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the counted rules keep.

    Every row is judged by its own text: null and empty texts go (too few words), equal rows stay or go together.
    """
    kept = quality.keep(docs)
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates.

    Texts without words and rows of a group without any id stay; rows with equal id and text stay or go together.
    """
    return near_dup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    Null and empty texts stay, and so does everything if the benchmark has no words; equal rows stay or go together.
    """
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.decontaminate(docs, benchmark)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to twice.

    A null source is a source of its own; texts without words add none and may be left out. Rows with equal
    id, source and text are all taken as often as the one of them that is taken most.
    """
    return mixing.mix(docs)


def sharding_by_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their size, their shard and their slot in it, in the order of the ids.

    Every row is placed, equal ones too, in shards of nearly equal bytes; a null text has the size 1. Input columns named
    ``size``, ``shard`` or ``slot`` are replaced.
    """
    return sharding.shard_by_bytes(docs, ["doc_id"], SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", sharding_by_bytes),
]

# Compression ratios, minhashes and Newton steps have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage returns is written and read back for the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "_"))
    return docs

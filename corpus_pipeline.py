"""The corpus pipeline: quality rules, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before has kept;
its output is written as Parquet and read again as the next one's input. All stages but the last
return the columns of documents, further columns included.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from payments_lake.llm.common import table, with_package, written
from payments_lake.llm.decontamination import decontaminated
from payments_lake.llm.jaccard_join import one_per_component
from payments_lake.llm.packing import pack
from payments_lake.llm.quality_rules import keep_good
from payments_lake.llm.secret_scan import redacted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified quality rules keep."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by similar texts."""
    return one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [(name, with_package(stage)) for name, stage in (
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("packing", packing),
)]

# Certified cutoffs, trained models and packing have no SQL form; tests compare the stages' row
# counts and columns only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages leave of the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

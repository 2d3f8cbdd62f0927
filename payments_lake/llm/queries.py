"""The queries ``opN_<name>`` on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from payments_lake.llm.centroid_clusters import clustered
from payments_lake.llm.common import table, with_package
from payments_lake.llm.decontamination import contained_items
from payments_lake.llm.jaccard_join import linked_components
from payments_lake.llm.license_scan import scanned
from payments_lake.llm.oracle import ORACLE
from payments_lake.llm.packing import pack
from payments_lake.llm.product_codes import product_codes
from payments_lake.llm.quality_rules import quality_rules
from payments_lake.llm.secret_scan import scan
from payments_lake.llm.token_counts import token_counts
from payments_lake.llm.toxicity import toxicity
from payments_lake.llm.warc import archived_pages
from payments_lake.llm.whole_model import whole_difference
from payments_lake.llm.wrapper_induction import main_texts

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page written as a WARC record and read back in chunks."""
    return archived_pages(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and base phrases of each document."""
    return scanned(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document by the 50,000-entry byte vocabulary."""
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base signals and verdict of each document."""
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each document at a similarity of three quarters."""
    return linked_components(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1,024 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each document, learned from labels that aren't held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and all spans of each document."""
    return scan(table(spark, sf_dir, "documents"))


def op9_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations are the target domain."""
    return whole_difference(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "conversations")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items of which a document has three quarters of the shingles."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of the 64-component embeddings after ten rounds."""
    return clustered(table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return main_texts(table(spark, sf_dir, "pages"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte codes of the embeddings after four rounds."""
    return product_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {name: with_package(query) for name, query in {
    "op1_warc_chunks": op1_warc_chunks,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_packing": op5_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_toxicity": op7_toxicity,
    "op8_secret_scan": op8_secret_scan,
    "op9_cross_entropy": op9_cross_entropy,
    "op10_decontamination": op10_decontamination,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_html_extraction": op12_html_extraction,
    "op13_vector_codes": op13_vector_codes,
}.items()}

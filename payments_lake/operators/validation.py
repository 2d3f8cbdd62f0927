"""Validation of the silver and gold outputs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payments_lake.functions import exact_total, nullify_tokens, percent
from payments_lake.operators.duplicates import hash_frequencies
from payments_lake.operators.gold import SPECS, TOTALS, MartSpec
from payments_lake.operators.report import (
    entries,
    percent_text,
    report_entries,
    union_reports,
)
from payments_lake.schema import FLAGS, REQUIRED_SILVER_COLUMNS, ROW_HASH

CHECK = "silver_output"
SUMMARISED = [*TOTALS, "record_count"]

PASS = "PASS"
WARN = "PASS_WITH_WARNINGS"


def missing_columns(frame: DataFrame, required: list[str]) -> list[str]:
    return [name for name in required if name not in frame.columns]


def _stored(silver: DataFrame, name: str) -> Column:
    """A silver value as a reader of the stored table sees it: missing tokens are null."""
    kinds = dict(silver.dtypes)
    return nullify_tokens(F.col(name)) if kinds[name] == "string" else F.col(name)


def flag_counts(silver: DataFrame) -> DataFrame:
    """Rows that carry each quality flag."""
    total = F.col("total_rows")
    counted = silver.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(f)).alias(f) for f in FLAGS]
    )
    return entries(
        counted,
        [(f, F.col(f), percent(F.col(f), total)) for f in FLAGS],
        ["flag", "true_count", "true_pct"],
    )


def silver_identity(silver: DataFrame) -> DataFrame:
    """Rows, distinct row hashes and the resulting status, as one row.

    Identical source rows share a hash and downgrade the status; nothing is removed.
    """
    if ROW_HASH in silver.columns:
        counted = hash_frequencies(silver).agg(
            F.coalesce(F.sum("records"), F.lit(0)).alias("row_count"),
            F.count("key").alias("unique_source_hash_count"),
        )
    else:
        counted = silver.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.lit(0).cast("bigint").alias("unique_source_hash_count"),
        )
    return _with_status(silver, counted)


def _with_status(silver: DataFrame, counted: DataFrame) -> DataFrame:
    """The identity columns from the counted rows and hashes, then what else was counted."""
    missing = missing_columns(silver, REQUIRED_SILVER_COLUMNS)
    identity = ["row_count", "unique_source_hash_count"]
    identical = F.col("row_count") == F.col("unique_source_hash_count")
    return counted.select(
        F.when(identical & F.lit(not missing), PASS).otherwise(WARN).alias("status"),
        "row_count",
        F.lit(len(silver.columns)).alias("column_count"),
        F.lit(", ".join(missing)).alias("missing_required_columns"),
        "unique_source_hash_count",
        percent(F.col("unique_source_hash_count"), F.col("row_count")).alias(
            "source_row_hash_uniqueness_pct"
        ),
        *[name for name in counted.columns if name not in identity],
    )


def _silver_counts(silver: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Rows, distinct row hashes, extent of the fiscal years and rows that pass each test, as one row.

    A row leaves its hash and a number whose bits say which tests it passes. Both are counted from one
    scan: hashes by themselves, so that they carry no counters through the shuffle, and the few
    combinations of bits and year, of which a task sends each once.
    """
    names = list(tests)
    bits = [F.when(test, 1 << i).otherwise(0).cast("bigint") for i, test in enumerate(tests.values())]
    marks = reduce(Column.bitwiseOR, bits, F.lit(0).cast("bigint"))
    year = F.col("fiscal_year") if "fiscal_year" in silver.columns else F.lit(None).cast("int")
    key = F.unhex(F.col(ROW_HASH)) if ROW_HASH in silver.columns else F.lit(None).cast("binary")
    counted = (
        silver.select(key.alias("key"), marks.alias("marks"), year.alias("year"))
        .groupingSets([["key"], ["marks", "year"]], "key", "marks", "year")
        .agg(F.count(F.lit(1)).alias("records"), F.grouping("key").alias("of_marks"))
    )
    combinations = counted.groupBy("of_marks", "marks", "year").agg(
        F.sum("records").alias("records"), F.count("key").alias("keys")
    )
    rows = F.when(F.col("of_marks") == 1, F.col("records")).otherwise(0)

    def passed(i: int) -> Column:
        return F.when(F.col("marks").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, rows)

    return combinations.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("keys"), F.lit(0)).alias("unique_source_hash_count"),
        *[F.coalesce(F.sum(passed(i)), F.lit(0)).alias(name) for i, name in enumerate(names)],
        F.min("year").alias("fy_min"),
        F.max("year").alias("fy_max"),
    )


def validate_silver(silver: DataFrame) -> DataFrame:
    """Required columns, row identity, fiscal year range, null and flag counts as a report.

    Silver, which may be derived as it is read, is scanned once.
    """
    present = [name for name in REQUIRED_SILVER_COLUMNS if name in silver.columns]
    flags = [name for name in FLAGS if name in silver.columns]
    counted = _silver_counts(
        silver,
        {
            **{f"n_{c}": _stored(silver, c).isNull() for c in present},
            **{f"t_{f}": F.col(f) for f in flags},
        },
    )
    total = F.col("row_count")
    rows = [
        ("", "status", F.col("status")),
        ("", "column_count", F.col("column_count")),
        ("", "missing_required_columns", F.col("missing_required_columns")),
        (ROW_HASH, "unique_count", F.col("unique_source_hash_count")),
        (ROW_HASH, "uniqueness_pct", percent_text(F.col("source_row_hash_uniqueness_pct"))),
        ("", "total_rows", total),
    ]
    if "fiscal_year" in silver.columns:
        rows += [("fiscal_year", "min", F.col("fy_min")), ("fiscal_year", "max", F.col("fy_max"))]
    for name in present:
        rows.append((name, "null_count", F.col(f"n_{name}")))
        rows.append((name, "null_pct", percent_text(percent(F.col(f"n_{name}"), total))))
    for name in flags:
        rows.append((name, "true_count", F.col(f"t_{name}")))
        rows.append((name, "true_pct", percent_text(percent(F.col(f"t_{name}"), total))))
    return report_entries(_with_status(silver, counted), CHECK, rows)


def mart_metric_summary(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Nulls and sum of the metric columns each mart has."""
    parts = []
    for name, mart in marts.items():
        metrics = [m for m in SUMMARISED if m in mart.columns]
        counted = mart.agg(
            *[F.count_if(F.col(m).isNull()).alias(f"n_{m}") for m in metrics],
            *[exact_total(F.col(m).cast("double")).alias(f"s_{m}") for m in metrics],
        )
        parts.append(
            entries(
                counted,
                [(name, m, F.col(f"n_{m}"), F.round(F.col(f"s_{m}"), 2)) for m in metrics],
                ["mart", "metric", "null_count", "metric_sum"],
            )
        )
    return union_reports(parts)


def required_columns(spec: MartSpec) -> list[str]:
    return [*spec.keys, *spec.required, "record_count"]


def validate_mart(name: str, mart: DataFrame) -> DataFrame:
    """Existence, rows, columns and status of one mart, as one row."""
    missing = missing_columns(mart, required_columns(SPECS[name]))
    status = (
        F.when(F.col("row_count") == 0, "FAIL: no rows")
        .when(F.lit(bool(missing)), "FAIL: missing required columns")
        .otherwise(PASS)
    )
    return mart.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("mart"),
        F.lit(True).alias("mart_exists"),
        "row_count",
        F.lit(len(mart.columns)).alias("column_count"),
        F.lit(", ".join(missing)).alias("missing_columns"),
        status.alias("status"),
    )


def absent_mart(name: str) -> DataFrame:
    """The row of a mart that was not written."""
    return SparkSession.active().range(1).select(
        F.lit(name).alias("mart"),
        F.lit(False).alias("mart_exists"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(0).alias("column_count"),
        F.lit("").alias("missing_columns"),
        F.lit("FAIL: file does not exist").alias("status"),
    )


def validate_gold(marts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per expected mart; a mart that is absent from ``marts`` fails."""
    return union_reports(
        [
            validate_mart(name, marts[name]) if name in marts else absent_mart(name)
            for name in SPECS
        ]
    )


def gold_status(validation: DataFrame) -> DataFrame:
    """Overall status and number of marts that passed and failed, as one row."""
    passed = F.count_if(F.col("status") == PASS)
    total = F.count(F.lit(1))
    return validation.agg(
        F.when(passed == total, PASS).otherwise("FAIL").alias("status"),
        total.alias("mart_count"),
        passed.alias("passed_mart_count"),
        (total - passed).alias("failed_mart_count"),
    )

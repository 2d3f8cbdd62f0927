"""One query per operator, over the payments ledger derived from the driver tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payments_lake.functions import (
    clean_contract_number,
    clean_numeric,
    clean_text,
    composite_key,
    fiscal_year,
    normalize_text,
    parse_date,
    parse_timestamp,
    year_month,
)
from payments_lake.operators import dimensions, duplicates, gold, missing, rules, structure
from payments_lake.operators import time as times
from payments_lake.operators import types, validation
from payments_lake.operators.sampling import stratified_sample
from payments_lake.operators.silver import quality_flags, silver_projection, to_silver
from payments_lake.plans.readiness import readiness_from_reports, readiness_summary
from payments_lake.schema import (
    AMOUNTS,
    AS_OF,
    BUSINESS_KEY,
    CONTRACT_NUMBER,
    CORRUPT_RECORD,
    DIMENSIONS,
    FILL_VALUE,
    FILLED_CODES,
    FISCAL_YEAR,
    FLAGS,
    KEY_CANDIDATES,
    LOADED_AT,
    PO_DATE,
    RAW_COLUMNS,
    RAW_TO_SILVER,
    ROW_HASH,
    ROW_ID,
    WIDTH,
)
from payments_lake.session import configure
from payments_lake.sources.bridge import as_landed, bridge, raw_table
from payments_lake.sources.raw_csv import file_sizes, land_raw, parse_records
from payments_lake.streaming import silver_stream_sample, stream_sample

Query = Callable[[SparkSession, str], DataFrame]

LINES_PER_FILE = 100_000


def readable(frame: DataFrame, rounded: bool = False) -> DataFrame:
    """Dates and timestamps as ISO text, and optionally doubles with two decimals."""

    def shown(name: str, kind: str) -> Column:
        if kind in ("date", "timestamp_ntz"):
            return F.col(name).cast("string").alias(name)
        if kind == "double" and rounded:
            return F.round(name, 2).alias(name)
        return F.col(name)

    return frame.select(*[shown(name, kind) for name, kind in frame.dtypes])


def on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: readable(operator(raw_table(configure(spark), sf_dir)))


def on_silver(operator: Callable[[DataFrame], DataFrame], rounded: bool = True) -> Query:
    return lambda spark, sf_dir: readable(
        operator(to_silver(raw_table(configure(spark), sf_dir))), rounded
    )


def per_row(columns: Callable[[], dict[str, Column]]) -> Query:
    """Scalar functions applied to every row, next to the row id."""
    return on_raw(
        lambda raw: raw.select(ROW_ID, *[c.alias(name) for name, c in columns().items()])
    )


def with_silver_names(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed(RAW_TO_SILVER)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local one only where all runs in one process."""
    key = "spark.checkpoint.dir"
    root = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{key} must name a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="ledger-")
    return f"{root.rstrip('/')}/ledger-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """A frame that several passes read, written once and read back, as the pipeline does. Hashes and
    ids are hex digits, of which zstd leaves about half and snappy all."""
    path = f"{shared_folder(frame.sparkSession)}/table"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def stored_columns(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Some columns of a frame, stored. The others, which no pass reads, are there as nulls."""
    kept = stored(frame.select(*[c.alias(name) for name, c in columns.items()]))
    return kept.select(
        *[
            F.col(name) if name in columns else F.lit(None).cast(kind).alias(name)
            for name, kind in frame.dtypes
        ]
    )


def stored_keys(raw: DataFrame, *more: str) -> DataFrame:
    """The cells of the candidate keys, which are counted and read again for their texts, stored."""
    names = dict.fromkeys([c for columns in KEY_CANDIDATES.values() for c in columns])
    return stored_columns(raw, {name: F.col(name) for name in [*names, *more]})


def stored_for_marts(silver: DataFrame) -> DataFrame:
    """The silver columns that marts read, stored. Marts only count which rows have a hash, so of the
    hash its presence is stored."""
    return stored(
        silver.select(
            *gold.BASE_KEYS,
            *gold.TOTALS.values(),
            *gold.FLAG_COUNTS.values(),
            F.when(F.col(ROW_HASH).isNotNull(), "").alias(ROW_HASH),
        )
    )


def marts(silver: DataFrame) -> dict[str, DataFrame]:
    kept = stored_for_marts(silver)
    return {spec.name: gold.build_mart(kept, spec) for spec in gold.MARTS}


def sketch_marts(silver: DataFrame) -> DataFrame:
    """All marts rolled up from the sketch base: rows and totals of each, and whether the estimated
    suppliers of every group lie within four standard errors of the exact ones."""
    parts = []
    silver = stored_for_marts(silver)
    estimated = gold.build_sketch_marts(silver, stored(gold.sketch_base(silver)))
    for spec in gold.MARTS:
        exact = gold.group_metrics(silver, spec.keys).select(
            *[F.col(key).alias(f"of_{key}") for key in spec.keys],
            F.col("unique_suppliers").alias("exact"),
        )
        same = F.lit(True)
        for key in spec.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"of_{key}"))
        most = F.greatest(F.lit(1.0), 4 * 0.0163 * F.col("exact"))
        parts.append(
            estimated[spec.name]
            .join(exact, same)
            .agg(
                F.lit(spec.name).alias("mart"),
                F.count(F.lit(1)).alias("row_count"),
                gold.exact_total(F.col("total_vouchers_paid")).alias("paid"),
                F.sum("record_count").alias("records"),
                F.bool_and(F.abs(F.col("unique_suppliers") - F.col("exact")) <= most).alias("near"),
            )
        )
    return missing.union_reports(parts)


def shared_base_marts(silver: DataFrame) -> DataFrame:
    """All marts rolled up from the shared base: rows and totals of each."""
    parts = []
    for name, mart in gold.build_marts(stored(gold.mart_base(silver))).items():
        parts.append(
            mart.agg(
                F.lit(name).alias("mart"),
                F.count(F.lit(1)).alias("row_count"),
                gold.exact_total(F.col("total_vouchers_paid")).alias("paid"),
                F.sum("record_count").alias("records"),
                F.sum("unique_suppliers").alias("suppliers"),
                F.sum("missing_po_date_records").alias("missing_po_dates"),
            )
        )
    return missing.union_reports(parts)


def with_record_text(cells: DataFrame) -> DataFrame:
    """Ledger rows with their CSV record text.

    Records with an unreadable order date lose their last two fields and those with an
    unreadable pending amount gain one, so that there are short and long records to find.
    """
    quoted = [
        F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
        for c in map(F.col, RAW_COLUMNS)
    ]
    short = F.coalesce(F.col(PO_DATE) == "unknown", F.lit(False))
    long = F.col("Vouchers Pending") == "pending"
    # concat_ws leaves out null parts.
    record = F.concat_ws(
        ",",
        *quoted[:-2],
        *[F.when(~short, field) for field in quoted[-2:]],
        F.when(~short & long, "surplus"),
    )
    return cells.select("*", record.alias("record"))


def record_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows as CSV record texts."""
    texts = with_record_text(bridge(configure(spark), sf_dir))
    return texts.select(F.col(ROW_ID).alias("row_id"), "record")


def stored_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field count per record, stored; ids and texts are kept of malformed records only, as the
    texts are by landing."""
    widths = structure.widths_of_records(record_texts(spark, sf_dir))
    malformed = F.col("width") != len(RAW_COLUMNS)
    return stored(
        widths.select(
            F.when(malformed, F.col("row_id")).alias("row_id"),
            "width",
            F.when(malformed, F.col("record")).alias("record"),
        )
    )


def on_records(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(
        structure.widths_of_records(record_texts(spark, sf_dir))
    )


def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_silver_names(parse_records(record_texts(spark, sf_dir), "record", ["row_id"]))


def raw_with_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows with the width and the text of their record, so that the ledger is derived once for
    both; the text is kept of malformed records only, as landing does."""
    texts = with_record_text(bridge(configure(spark), sf_dir))
    records = structure.widths_of_records(texts, row_id=ROW_ID, keep=[*RAW_COLUMNS, ROW_ID])
    malformed = F.col("width") != len(RAW_COLUMNS)
    return as_landed(
        records,
        F.col("width").alias(WIDTH),
        F.when(malformed, F.col("record")).alias(CORRUPT_RECORD),
    )


def readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row carries the width of its record, as a landed one does, so the ledger is derived once."""
    return readiness_summary(raw_with_records(spark, sf_dir), carried_widths=True)


def readiness_of_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger and the reports of its profiles as tables, and readiness from the reports alone."""
    folder = shared_folder(configure(spark))
    raw = stored(raw_with_records(spark, sf_dir))
    profiles = [
        structure.profile_file_structure(structure.widths_of_landed(raw)),
        structure.profile_schema(raw),
        types.profile_data_types(raw),
        missing.profile_missing(raw),
        rules.profile_business_rules(raw),
        duplicates.profile_duplicates(raw, stored),
        dimensions.profile_dimensions(raw),
        times.profile_time_coverage(raw),
    ]
    for i, profile in enumerate(profiles):
        profile.write.parquet(f"{folder}/reports/{i}")
    reports = [spark.read.parquet(f"{folder}/reports/{i}") for i in range(len(profiles))]
    return readiness_from_reports(missing.union_reports(reports))


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger written as CSV files of unequal size with a header each, and landed from them.

    Each task writes the records that it derives, as their texts are long. A file holds as many lines
    as one task can read when compressed, the last one of a task what is left.
    """
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    lines = max(2, min(LINES_PER_FILE, rows // 7))
    header = ",".join(f'"{name}"' for name in RAW_COLUMNS)
    # Numbers the records of a task from 0. A file begins after every ``lines`` lines.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    records = record_texts(spark, sf_dir).select("record", number.alias("number"))
    first = F.col("number") % (lines - 1) == 0
    folder = shared_folder(spark)
    (
        records.select(
            F.explode(
                F.when(first, F.array(F.lit(header), F.col("record"))).otherwise(F.array("record"))
            ).alias("line")
        )
        .write.option("compression", "snappy")
        .option("maxRecordsPerFile", lines)
        .text(f"{folder}/raw")
    )
    return land_raw(spark, f"{folder}/raw", f"{folder}/landed", strict=False)


def scanned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_files(configure(spark), sf_dir)
    return with_silver_names(landed.select(*RAW_COLUMNS, F.col(WIDTH).alias("width")))


def failing_marts(silver: DataFrame) -> DataFrame:
    """Validation of marts of which one is absent, one empty, and one lacks a column."""
    built = marts(silver)
    absent, empty, narrow = list(built)[:3]
    del built[absent]
    built[empty] = built[empty].filter(F.lit(False))
    built[narrow] = built[narrow].drop("record_count")
    return validation.validate_gold(built)


def lineitem_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_sizes(spark, f"{sf_dir}/lineitem.parquet").select(
        F.regexp_extract("file_path", "[^/]+$", 0).alias("file_name"), "file_bytes", "file_mb"
    )


def _silver(c: str) -> str:
    return RAW_TO_SILVER[c]


QUERIES: dict[str, Query] = {
    # scalar functions
    "clean_numeric": per_row(lambda: {_silver(c): clean_numeric(F.col(c)) for c in AMOUNTS}),
    "parse_timestamp": per_row(lambda: {c: parse_timestamp(F.col(c)) for c in (AS_OF, LOADED_AT)}),
    "parse_date": per_row(lambda: {_silver(PO_DATE): parse_date(F.col(PO_DATE))}),
    "fiscal_year": per_row(lambda: {"fiscal_year": fiscal_year(F.col(FISCAL_YEAR))}),
    "clean_text": per_row(
        lambda: {
            **{_silver(c): clean_text(F.col(c)) for c in DIMENSIONS},
            **{_silver(c): clean_text(F.col(c), FILL_VALUE) for c in FILLED_CODES},
        }
    ),
    "normalize_text": per_row(
        lambda: {_silver(c): normalize_text(F.col(c), FILL_VALUE) for c in DIMENSIONS}
    ),
    "clean_contract_number": per_row(
        lambda: {"contract_number": clean_contract_number(F.col(CONTRACT_NUMBER))}
    ),
    "nullify_tokens": on_raw(lambda raw: with_silver_names(raw.drop(ROW_HASH))),
    "business_composite_key": per_row(lambda: {"business_composite_key": composite_key(BUSINESS_KEY)}),
    "source_row_hash": on_raw(lambda raw: raw.select(ROW_ID, ROW_HASH)),
    "po_year_month": per_row(
        lambda: {
            "po_year": F.year(parse_date(F.col(PO_DATE))),
            "po_month": year_month(parse_date(F.col(PO_DATE))),
        }
    ),
    "quality_flags": on_raw(
        lambda raw: quality_flags(silver_projection(raw)).select(
            ROW_HASH, *FLAGS, "po_year", "po_month"
        )
    ),
    "silver_projection": on_raw(
        lambda raw: silver_projection(raw).drop("_raw_department_missing")
    ),
    "silver_transform": on_silver(lambda silver: silver, rounded=False),
    "silver_flags_from_raw": on_raw(
        lambda raw: to_silver(raw, flag_from="raw").select(ROW_HASH, *FLAGS)
    ),
    # gold
    **{
        spec.name: on_silver(lambda silver, spec=spec: gold.build_mart(silver, spec))
        for spec in gold.MARTS
    },
    "group_metrics": on_silver(
        lambda silver: gold.group_metrics(
            silver, ["fiscal_year", "purchasing_authority_description"]
        )
    ),
    "gold_marts_from_base": on_silver(shared_base_marts),
    "gold_marts_from_sketches": on_silver(sketch_marts),
    # missing values and types
    "null_counts": on_raw(missing.null_counts),
    "critical_missing_rows": on_raw(missing.critical_missing_rows),
    "warning_missing_rows": on_raw(missing.warning_missing_rows),
    "missing_examples": on_raw(missing.warning_examples),
    "critical_examples": on_raw(missing.critical_examples),
    "parse_failures": on_raw(types.parse_failures),
    "column_ranges": on_raw(types.column_ranges),
    "profile_missing": on_raw(missing.profile_missing),
    "profile_data_types": on_raw(types.profile_data_types),
    # business rules
    "amount_profile": on_raw(rules.amount_profile),
    "amount_extremes": on_raw(rules.amount_extremes),
    "date_order_violations": on_raw(rules.date_order_violations),
    "fiscal_year_mismatch": on_raw(rules.fiscal_year_mismatch),
    "fiscal_year_distribution": on_raw(rules.fiscal_year_distribution),
    "violation_examples": on_raw(rules.violation_examples),
    "profile_business_rules": on_raw(rules.profile_business_rules),
    # keys
    "key_profile": on_raw(duplicates.key_profile),
    "full_row_duplicates": on_raw(duplicates.full_row_duplicates),
    "top_duplicate_keys": on_raw(
        lambda raw: duplicates.top_duplicate_keys(stored_keys(raw), keep=stored)
    ),
    "direct_payment_share": on_raw(duplicates.direct_payment_share),
    "profile_duplicates": on_raw(
        lambda raw: duplicates.profile_duplicates(stored_keys(raw, ROW_HASH), stored)
    ),
    # dimensions
    "dimension_cardinality": on_raw(dimensions.dimension_cardinality),
    "dimension_top_values": on_raw(dimensions.dimension_top_values),
    "special_values": on_raw(dimensions.special_values),
    "profile_dimensions": on_raw(dimensions.profile_dimensions),
    # time
    "time_ranges": on_raw(times.time_ranges),
    "date_quality": on_raw(times.date_quality),
    "po_year_distribution": on_raw(times.po_year_distribution),
    "as_of_year_distribution": on_raw(times.as_of_year_distribution),
    "top_po_months": on_raw(times.top_po_months),
    "top_as_of_months": on_raw(times.top_as_of_months),
    "freshness": on_raw(times.freshness),
    "as_of_year_mismatch": on_raw(times.as_of_year_mismatch),
    "profile_time_coverage": on_raw(times.profile_time_coverage),
    # validation
    "validate_silver": on_silver(validation.validate_silver),
    "flag_counts": on_silver(validation.flag_counts, rounded=False),
    "mart_metric_summary": on_silver(
        lambda silver: validation.mart_metric_summary(marts(silver))
    ),
    "validate_silver_incomplete": on_silver(
        lambda silver: validation.validate_silver(silver.drop("department", "po_month"))
    ),
    "validate_gold_failing": on_silver(failing_marts),
    "validate_gold": on_silver(lambda silver: validation.validate_gold(marts(silver))),
    "readiness_summary": readiness,
    "readiness_from_reports": readiness_of_reports,
    # sampling
    "stratified_sample": on_raw(
        lambda raw: with_silver_names(stratified_sample(raw, strict=False))
    ),
    "simple_sample": on_raw(lambda raw: with_silver_names(stream_sample(raw, n=1000))),
    "silver_stream_sample": on_raw(lambda raw: silver_stream_sample(raw, n=1000)),
    # schema and files
    "parse_records": parsed_records,
    "raw_scan": scanned_cells,
    "landed_widths": lambda spark, sf_dir: structure.row_width_histogram(
        structure.widths_of_landed(landed_files(configure(spark), sf_dir))
    ),
    "type_profile": on_raw(structure.type_profile),
    "sample_values": on_raw(structure.sample_values),
    "profile_schema": on_raw(lambda raw: structure.profile_schema(stored(raw.drop(ROW_HASH)))),
    "row_width_histogram": on_records(structure.row_width_histogram),
    "malformed_records": on_records(structure.malformed_records),
    "profile_file_structure": lambda spark, sf_dir: structure.profile_file_structure(
        stored_widths(spark, sf_dir)
    ),
    "file_sizes": lineitem_files,
}

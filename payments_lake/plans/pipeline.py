"""The batch pipeline: land, silver, gold, validate, summarise."""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from payments_lake import __version__
from payments_lake.operators.dimensions import profile_dimensions
from payments_lake.operators.duplicates import profile_duplicates
from payments_lake.operators.gold import (
    MARTS,
    build_marts,
    build_sketch_marts,
    mart_base,
    sketch_base,
)
from payments_lake.operators.missing import missing_example_report, profile_missing
from payments_lake.operators.rules import profile_business_rules, rule_example_report
from payments_lake.operators.sampling import ROWS_PER_YEAR, stratified_sample
from payments_lake.operators.silver import to_silver
from payments_lake.operators.structure import (
    head_rows,
    profile_landed,
    profile_schema,
)
from payments_lake.operators.time import profile_time_coverage
from payments_lake.operators.types import profile_data_types
from payments_lake.operators.validation import (
    gold_status,
    mart_metric_summary,
    validate_gold,
    validate_silver,
)
from payments_lake.plans.readiness import readiness_from_reports
from payments_lake.schema import ROW_HASH
from payments_lake.session import configure
from payments_lake.sources import (
    file_sizes,
    land_raw,
    read_silver,
    read_table,
    write_silver,
    write_table,
)
from payments_lake.streaming import silver_stream_sample, stream_sample


@dataclass(frozen=True)
class Layout:
    """Where the tables of one run lie below its output folder, which all executors can reach."""

    root: str

    @property
    def landed(self) -> str:
        return f"{self.root}/landed"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold_base(self) -> str:
        return f"{self.root}/gold_base"

    def mart(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def report(self, name: str) -> str:
        return f"{self.root}/reports/{name}"

    def kept(self, name: str) -> str:
        return f"{self.root}/kept/{name}"

    def sample(self, name: str) -> str:
        return f"{self.root}/samples/{name}"


def transform_to_silver(
    spark: SparkSession, raw_path: str, layout: Layout, multiline: bool | None = None
) -> dict:
    """Land the raw files and write silver, which is counted while it is written."""
    landed = land_raw(spark, raw_path, layout.landed, multiline)
    silver = Observation()
    write_silver(
        to_silver(landed), layout.silver, observe=(silver, F.count(F.lit(1)).alias("rows"))
    )
    return {
        # From the footers of the landed files. A count that is observed before a shuffle would
        # count rows twice where lost tasks run again.
        "source_rows": landed.count(),
        "silver_rows": silver.get["rows"],
        "output": layout.silver,
        "available": True,
    }


def build_gold_marts(
    spark: SparkSession, layout: Layout, fmt: str = "parquet", suppliers: str = "exact"
) -> dict:
    """Write the five marts. Silver is scanned once, for the base they all roll up.

    ``suppliers="sketch"`` estimates distinct suppliers, which keeps the base small however many
    suppliers there are; the supplier mart then scans silver on its own.
    """
    if suppliers not in ("exact", "sketch"):
        raise ValueError(f"suppliers are counted 'exact' or by 'sketch', not {suppliers!r}")
    silver = read_silver(spark, layout.silver)
    write_table(mart_base(silver) if suppliers == "exact" else sketch_base(silver), layout.gold_base)
    base = read_table(spark, layout.gold_base)
    marts = build_marts(base) if suppliers == "exact" else build_sketch_marts(silver, base)
    written = []
    for name, mart in marts.items():
        write_table(mart, layout.mart(name), fmt)
        written.append(
            {
                "name": name,
                "row_count": _read_mart(spark, layout.mart(name), fmt).count(),
                "output": layout.mart(name),
                "available": True,
            }
        )
    return {"mart_count": len(written), "marts": written}


def _read_mart(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.options(header=True, inferSchema=True, escape='"').csv(path)
    return read_table(spark, path)


def read_marts(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The marts that exist."""
    found = {}
    for spec in MARTS:
        try:
            found[spec.name] = _read_mart(spark, layout.mart(spec.name), fmt)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def check_silver(spark: SparkSession, layout: Layout) -> dict:
    """Write the silver report; return its status, row identity, null and flag counts."""
    silver = read_silver(spark, layout.silver)
    write_table(validate_silver(silver), layout.report("silver_output"))
    # A row per metric of 26 required columns, whatever the size of silver.
    report = read_table(spark, layout.report("silver_output")).collect()
    value = {(row["column_name"], row["metric"]): row["value"] for row in report}

    def counts(metric: str) -> dict[str, int]:
        return {column: int(v) for (column, m), v in value.items() if m == metric}

    missing = value["", "missing_required_columns"]
    return {
        "status": value["", "status"],
        "row_count": int(value["", "total_rows"]),
        "column_count": int(value["", "column_count"]),
        "missing_required_columns": missing.split(", ") if missing else [],
        "unique_source_hash_count": int(value[ROW_HASH, "unique_count"]),
        "source_row_hash_uniqueness_pct": float(value[ROW_HASH, "uniqueness_pct"]),
        "fiscal_year_min": value.get(("fiscal_year", "min")),
        "fiscal_year_max": value.get(("fiscal_year", "max")),
        "null_counts": counts("null_count"),
        "quality_flag_true_counts": counts("true_count"),
        "report": layout.report("silver_output"),
    }


def check_gold(spark: SparkSession, layout: Layout, fmt: str = "parquet") -> dict:
    """Write the gold reports; return the overall status and the result per mart."""
    marts = read_marts(spark, layout, fmt)
    write_table(validate_gold(marts), layout.report("gold_output"))
    if marts:
        write_table(mart_metric_summary(marts), layout.report("gold_metrics"))
    results = read_table(spark, layout.report("gold_output"))
    return {
        **gold_status(results).first().asDict(),
        "marts": [row.asDict() for row in results.collect()],  # one row per mart
    }


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """Write the run summary as one JSON record."""
    text = json.dumps(summary, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def run(
    spark: SparkSession,
    raw_path: str,
    out_dir: str,
    mode: str = "FULL",
    multiline: bool | None = None,
    mart_format: str = "parquet",
) -> dict:
    """Raw files to silver, marts, validation reports and a run summary."""
    started = time.monotonic()
    configure(spark)
    layout = Layout(out_dir)
    silver = transform_to_silver(spark, raw_path, layout, multiline)
    gold = build_gold_marts(spark, layout, mart_format)
    checked_silver = check_silver(spark, layout)
    checked_gold = check_gold(spark, layout, mart_format)
    clean = (
        checked_silver["status"] == "PASS"
        and checked_gold["status"] == "PASS"
        and silver["source_rows"] == silver["silver_rows"]
    )
    summary = {
        "project": "payments_lake",
        "pipeline_version": __version__,
        "generated_at": datetime.now(UTC).isoformat(),
        "mode": mode,
        "status": "success" if clean else "success_with_warnings",
        "runtime_seconds": round(time.monotonic() - started, 2),
        "source": {"file": raw_path, "row_count": silver["source_rows"], "available": True},
        "silver": {
            "file": silver["output"],
            "row_count": silver["silver_rows"],
            "available": silver["available"],
        },
        "gold": gold,
        "validation": {"silver": checked_silver, "gold": checked_gold},
    }
    write_summary(spark, summary, f"{out_dir}/summary")
    return summary


def profile(spark: SparkSession, raw_path: str, out_dir: str, head: int | None = None) -> None:
    """Write the readiness profiles of the landed table as report tables.

    Run after :func:`run` or :func:`~payments_lake.sources.land_raw`. The raw files are listed for
    their sizes but not read again. ``head`` takes types and sample values from the first so many
    rows; by default all rows are read.
    """
    layout = Layout(out_dir)
    landed = read_table(spark, layout.landed)
    numbers = itertools.count()

    def keep(frame: DataFrame) -> DataFrame:
        path = layout.kept(f"duplicates_{next(numbers)}")
        write_table(frame, path)
        return read_table(spark, path)

    reports: dict[str, Callable[[], DataFrame]] = {
        "file_structure": lambda: profile_landed(landed, file_sizes(spark, raw_path)),
        "schema": lambda: profile_schema(
            landed, None if head is None else head_rows(landed, head)
        ),
        "data_types": lambda: profile_data_types(landed),
        "missing_values": lambda: profile_missing(landed).unionByName(
            missing_example_report(landed)
        ),
        "duplicates": lambda: profile_duplicates(landed, keep),
        "business_rules": lambda: profile_business_rules(landed).unionByName(
            rule_example_report(landed)
        ),
        "dimensions": lambda: profile_dimensions(landed),
        "time_coverage": lambda: profile_time_coverage(landed),
    }
    for name, build in reports.items():
        write_table(build(), layout.report(name))
    written = [read_table(spark, layout.report(name)) for name in reports]
    write_table(
        readiness_from_reports(reduce(DataFrame.unionByName, written)), layout.report("readiness")
    )


def create_samples(
    spark: SparkSession, out_dir: str, per_year: int = ROWS_PER_YEAR, strict: bool = True
) -> None:
    """Write the stratified sample and the raw and silver stream samples of the landed table."""
    layout = Layout(out_dir)
    landed = read_table(spark, layout.landed)
    write_table(
        stratified_sample(landed, per_year, strict=strict), layout.sample("by_fiscal_year"), "csv"
    )
    write_table(stream_sample(landed), layout.sample("stream"), "csv")
    write_table(silver_stream_sample(landed), layout.sample("stream_silver"))

"""Time the pipeline and the headline profiles; print one JSON line.

The driver tables are first written as raw CSV files of the ledger, which is not timed. From
there on the work is that of a real run: CSV to landed text to silver to marts and reports. On a
cluster BENCH_ROOT names a new folder on shared storage; the default suits one machine only.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payments_lake.operators import dimensions, duplicates, gold, missing, rules
from payments_lake.operators import time as times
from payments_lake.operators import types, validation
from payments_lake.operators.sampling import stratified_sample
from payments_lake.operators.silver import to_silver
from payments_lake.plans.pipeline import Layout, build_gold_marts, check_gold, check_silver
from payments_lake.schema import RAW_COLUMNS
from payments_lake.session import configure
from payments_lake.sources import land_raw, read_landed, read_silver, write_silver
from payments_lake.sources.bridge import bridge

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BASELINE_ROWS_PER_SECOND = 5503


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("payments_lake_bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def drain(frame: DataFrame) -> None:
    """Compute every row without keeping any."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    root = os.environ.get("BENCH_ROOT") or tempfile.mkdtemp(prefix="/tmp/run-")
    raw = f"{root}/raw"
    ledger = bridge(spark, SF_DIR).select(*RAW_COLUMNS).repartition(int(CPUS))
    ledger.write.option("header", True).option("escape", '"').csv(raw)
    layout = Layout(f"{root}/out")

    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object]) -> None:
        started = time.monotonic()
        work()
        seconds[name] = round(time.monotonic() - started, 3)

    # The pipeline, in order.
    timed("land_raw", lambda: land_raw(spark, raw, layout.landed))
    landed = read_landed(spark, layout.landed)
    timed("silver_transform", lambda: write_silver(to_silver(landed), layout.silver))
    timed("gold_marts", lambda: build_gold_marts(spark, layout))
    timed("validate_silver", lambda: check_silver(spark, layout))
    timed("validate_gold", lambda: check_gold(spark, layout))
    pipeline_seconds = sum(seconds.values())

    # Single marts straight from silver, and the profiles.
    silver = read_silver(spark, layout.silver)
    for spec in gold.MARTS:
        timed(spec.name, lambda spec=spec: drain(gold.build_mart(silver, spec)))
    timed("flag_counts", lambda: drain(validation.flag_counts(silver)))
    profiles = {
        "profile_missing": missing.profile_missing,
        "profile_data_types": types.profile_data_types,
        "profile_business_rules": rules.profile_business_rules,
        "key_profile": duplicates.key_profile,
        "full_row_duplicates": duplicates.full_row_duplicates,
        "profile_dimensions": dimensions.profile_dimensions,
        "profile_time_coverage": times.profile_time_coverage,
        "stratified_sample": lambda frame: stratified_sample(frame, strict=False),
    }
    for name, profile in profiles.items():
        timed(name, lambda profile=profile: drain(profile(landed)))

    rows = landed.count()
    print(
        json.dumps(
            {
                "metric": "payments_lake_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "rows": rows,
                "pipeline_seconds": round(pipeline_seconds, 3),
                "pipeline_rows_per_second": round(rows / pipeline_seconds),
                "baseline_rows_per_second": BASELINE_ROWS_PER_SECOND,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Silver, gold and report tables on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from payments_lake.schema import SILVER_COLUMNS, SILVER_SCHEMA


ROWS_PER_FILE = 2_000_000
PLAUSIBLE_YEARS = range(1900, 2200)


def by_year(silver: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Silver in partitions of one fiscal year and about ``rows_per_file`` rows each.

    Years are counted first (a scan of one column, at most 301 rows), so that a year that holds most
    rows is cut evenly without adaptive execution. Missing and implausible years, which may be many,
    count as one. Rows are dealt out by their place in the input, so copies of a row spread too;
    the input should come straight from files, whose order is the same when a task runs again.
    """
    year = F.coalesce(
        F.when(F.col("fiscal_year").isin(*PLAUSIBLE_YEARS), F.col("fiscal_year")), F.lit(0)
    )
    counted = silver.groupBy(year.alias("year")).count().collect()
    cuts = {row["year"]: -(-row["count"] // rows_per_file) for row in sorted(counted)}
    if not cuts:
        return silver
    starts, total = {}, 0
    for one, parts in cuts.items():
        starts[one] = total
        total += parts

    def of_year(numbers: dict[int, int]) -> Column:
        return F.create_map(*[F.lit(v) for pair in numbers.items() for v in pair])[year]

    part = of_year(starts) + F.pmod(F.monotonically_increasing_id(), of_year(cuts))
    return silver.repartitionById(total, part.cast("int"))


def write_silver(
    silver: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    observe: tuple[Observation, Column] | None = None,
) -> None:
    """Write silver partitioned by fiscal year. ``observe`` is filled from the rows as written.

    Without the layout every task would write a file per year. With it a file holds one year and at
    most ``rows_per_file`` rows, so neither tiny files nor one huge task result.
    """
    laid_out = by_year(silver, rows_per_file)
    if observe is not None:
        laid_out = laid_out.observe(*observe)
    (
        laid_out.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("fiscal_year")
        .parquet(path)
    )


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(path).select(*SILVER_COLUMNS)


def write_table(table: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a mart, sample or report, replacing an earlier one."""
    options = {"header": True, "escape": '"'} if fmt == "csv" else {}
    table.write.mode("overwrite").format(fmt).options(**options).save(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

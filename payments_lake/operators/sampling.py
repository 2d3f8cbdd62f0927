"""Repeatable exact-size samples.

Rows are ordered by the MD5 of their id and a seed, which is uniform, so the first hex digits
cut the table into even slices. Counting rows per slice tells which slices hold the wanted
rows; only those are sorted, never the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payments_lake.functions import fiscal_year_number
from payments_lake.schema import FISCAL_YEAR, RAW_COLUMNS, ROW_ID, assert_raw_schema

SEED = 42
ROWS_PER_YEAR = 500
SLICE_DIGITS = 4  # 65,536 slices

KEY = "_sample_key"
SLICE = "_sample_slice"
STRATUM = "_stratum"


def sample_key(row_id: str = ROW_ID, seed: int = SEED) -> Column:
    """Pseudo-random order of rows that repeats for the same ids and seed."""
    return F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed))))


def _keyed(raw: DataFrame, row_id: str, seed: int) -> DataFrame:
    keyed = assert_raw_schema(raw).withColumn(KEY, sample_key(row_id, seed))
    return keyed.withColumn(SLICE, F.left(KEY, F.lit(SLICE_DIGITS)))


def _rows_in_earlier_slices(*group: str) -> Column:
    # At most 65,536 rows per group, whatever the size of the table.
    window = (
        Window.partitionBy(*group)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum("rows").over(window), F.lit(0))


def simple_sample(raw: DataFrame, n: int, seed: int = SEED, row_id: str = ROW_ID) -> DataFrame:
    """``n`` rows without replacement, or all rows when there are fewer."""
    keyed = _keyed(raw, row_id, seed)
    slices = keyed.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
    counted = slices.withColumn("before", _rows_in_earlier_slices())
    wanted = counted.filter(F.col("before") < n)
    last, missing = wanted.agg(F.max(SLICE)).scalar(), F.lit(n) - wanted.agg(F.max("before")).scalar()
    # Earlier slices are taken whole; rows of the last one by rank. Slices are ranked side by side.
    rank = F.row_number().over(Window.partitionBy(SLICE).orderBy(KEY))
    ranked = keyed.filter(F.col(SLICE) <= last).withColumn("_rank", rank)
    return ranked.filter((F.col(SLICE) < last) | (F.col("_rank") <= missing)).select(*RAW_COLUMNS)


def stratified_sample(
    raw: DataFrame,
    n: int = ROWS_PER_YEAR,
    seed: int = SEED,
    strict: bool = True,
    row_id: str = ROW_ID,
) -> DataFrame:
    """``n`` rows of every fiscal year; rows without a readable year belong to none.

    ``strict`` fails when some year has fewer rows, otherwise such a year gives all it has.
    """
    keyed = _keyed(raw, row_id, seed).withColumn(
        STRATUM, fiscal_year_number(F.col(FISCAL_YEAR))
    )
    keyed = keyed.filter(F.col(STRATUM).isNotNull())
    slices = keyed.groupBy(STRATUM, SLICE).agg(F.count(F.lit(1)).alias("rows"))
    needed = F.when(F.col("before") < n, F.col(SLICE))
    strata = (
        slices.withColumn("before", _rows_in_earlier_slices(STRATUM))
        .groupBy(STRATUM)
        .agg(F.sum("rows").alias("total"), F.max(needed).alias("last_slice"))
    )
    # One row per stratum. Its size is unknown when the join is planned, so that without the hint all
    # rows would be dealt out by year, a dozen values. The last slice of all is a filter that reaches
    # below the projection of the cells.
    furthest = strata.agg(F.max("last_slice")).scalar()
    candidates = (
        keyed.filter(F.col(SLICE) <= furthest)
        .join(F.broadcast(strata.drop("total")), STRATUM)
        .filter(F.col(SLICE) <= F.col("last_slice"))
    )
    if strict:
        smallest = strata.agg(F.min("total")).scalar()
        enough = F.when(
            smallest < n, F.raise_error(F.lit(f"A fiscal year has fewer than {n} rows"))
        ).otherwise(F.lit(True))
        candidates = candidates.filter(enough)
    rank = F.row_number().over(Window.partitionBy(STRATUM).orderBy(KEY))
    return candidates.withColumn("_rank", rank).filter(F.col("_rank") <= n).select(*RAW_COLUMNS)

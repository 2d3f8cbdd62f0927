"""The long report format and the counting patterns that the profiles share."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payments_lake.functions import percent

REPORT_COLUMNS = ["check", "column_name", "metric", "value"]


def percent_text(c: Column) -> Column:
    """Percent as text with exactly four decimals."""
    return c.cast("decimal(9,4)").cast("string")


def number_text(c: Column) -> Column:
    """Amount as text with exactly two decimals; infinities are spelled out."""
    return F.coalesce(c.try_cast("decimal(38,2)").cast("string"), c.cast("string"))


def entries(one_row: DataFrame, rows: Iterable[Sequence[str | Column]], names: Sequence[str]) -> DataFrame:
    """Turn a single-row aggregate into rows: every entry lists the values for ``names``."""
    structs = [
        F.struct(
            *[
                (F.lit(v) if isinstance(v, str) else v).alias(name)
                for v, name in zip(row, names, strict=True)
            ]
        )
        for row in rows
    ]
    return one_row.select(F.inline(F.array(*structs)))


def report_entries(
    one_row: DataFrame, check: str, rows: Iterable[tuple[str, str, Column]]
) -> DataFrame:
    """Report rows ``(check, column_name, metric, value)`` from a single-row aggregate."""
    return entries(
        one_row,
        [(check, column, metric, value.cast("string")) for column, metric, value in rows],
        REPORT_COLUMNS,
    )


def wide_to_report(
    frame: DataFrame, check: str, column_name: Column, values: dict[str, Column]
) -> DataFrame:
    """Report rows from a frame with one row per subject; ``values`` maps metric to its text."""
    pairs = F.array(
        *[
            F.struct(F.lit(metric).alias("metric"), value.cast("string").alias("value"))
            for metric, value in values.items()
        ]
    )
    return frame.select(
        F.lit(check).alias("check"), column_name.alias("column_name"), F.inline(pairs)
    )


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def frequencies(frame: DataFrame, kinds: Sequence[str], kind: str = "kind") -> DataFrame:
    """How often each value of several text columns occurs, counted in one pass.

    Rows are unfolded to ``(kind, value)`` and counted before the shuffle, so what moves is the
    distinct values of a task, whatever the share of the most frequent one.
    """
    return (
        frame.select(*kinds)
        .unpivot([], list(kinds), kind, "value")
        .groupBy(kind, "value")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def counted_kind(kind: str = "kind") -> Column:
    """The kind of a counted value, for filters that must stay above the count.

    A filter on the plain column moves below the aggregation, and branches that keep different
    kinds then scan and count the table each on their own instead of sharing one shuffle.
    """
    return F.when(F.col("records") > 0, F.col(kind))


def top_per_group(
    frame: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group.

    Spark keeps the first ``k`` per group on each side of the shuffle (window group limit), so a
    group of any size arrives as at most ``k`` rows a task.
    """
    numbered = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return frame.withColumn(rank, numbered).filter(F.col(rank) <= k)


def with_share(
    freq: DataFrame, group: str, totals: DataFrame, count: str = "records", total: str = "total"
) -> DataFrame:
    """Add the percentage of the group total.

    ``totals`` holds one row per profiled column name, a dozen at most, and is therefore
    broadcast; the counted values stay where they are.
    """
    return freq.join(F.broadcast(totals), group).withColumn(
        "pct", percent(F.col(count), F.col(total))
    )

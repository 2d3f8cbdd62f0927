"""Gold marts: grouped spending metrics over silver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.functions import exact_total, nullify_tokens
from payments_lake.functions.numbers import exact_part, merge_totals, rest_part

# Metric name -> summed silver column.
TOTALS = {
    "total_vouchers_paid": "vouchers_paid",
    "total_vouchers_pending": "vouchers_pending",
    "total_encumbrance_balance": "encumbrance_balance",
    "total_pending_retainage": "vouchers_pending_retainage",
}
# Metric name -> counted silver flag.
FLAG_COUNTS = {
    "negative_paid_records": "is_negative_paid",
    "large_paid_1m_records": "is_large_paid_1m",
    "missing_po_date_records": "is_missing_purchase_order_date",
}
METRICS = [*TOTALS, "record_count", "unique_suppliers", *FLAG_COUNTS]


@dataclass(frozen=True)
class MartSpec:
    """One mart: group keys, sort order, optional row limit and non-zero filter."""

    name: str
    keys: tuple[str, ...]
    sort: tuple[tuple[str, bool], ...]  # (column, ascending)
    top_n: int | None = None
    nonzero: str | None = None
    required: tuple[str, ...] = ()


# The marts, their order and the columns each must have.
MARTS = [
    MartSpec(
        "mart_spending_by_fiscal_year",
        ("fiscal_year",),
        (("fiscal_year", True),),
        required=("total_vouchers_paid", "total_vouchers_pending"),
    ),
    MartSpec(
        "mart_spending_by_department",
        ("fiscal_year", "organization_group", "department"),
        (("fiscal_year", True), ("total_vouchers_paid", False)),
        required=("total_vouchers_paid",),
    ),
    MartSpec(
        "mart_spending_by_supplier_top_n",
        ("supplier_name",),
        (("total_vouchers_paid", False),),
        top_n=100,
        required=("total_vouchers_paid",),
    ),
    MartSpec(
        "mart_pending_by_department",
        ("fiscal_year", "department"),
        (("fiscal_year", True), ("total_vouchers_pending", False)),
        nonzero="total_vouchers_pending",
        required=("total_vouchers_pending",),
    ),
    MartSpec(
        "mart_fund_category_summary",
        ("fiscal_year", "fund_type", "fund_category"),
        (("fiscal_year", True), ("total_vouchers_paid", False)),
        required=("total_vouchers_paid",),
    ),
]
SPECS = {spec.name: spec for spec in MARTS}

# Every mart key and the supplier: the grain from which all marts can be rolled up.
BASE_KEYS = [
    "fiscal_year",
    "organization_group",
    "department",
    "fund_type",
    "fund_category",
    "supplier_name",
]


def grouping_text(silver: DataFrame) -> DataFrame:
    """Silver with blank or missing-token text in group columns as null, one group for both."""
    text = [name for name, kind in silver.dtypes if name in BASE_KEYS and kind == "string"]
    return silver.withColumns({name: nullify_tokens(F.col(name)) for name in text})


def group_metrics(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The nine metrics per group. Null keys form a group; sums of no values are 0."""
    text_keys = [
        name
        for name, kind in silver.dtypes
        if kind == "string" and name in {*keys, "supplier_name"}
    ]
    return (
        silver.withColumns({name: nullify_tokens(F.col(name)) for name in text_keys})
        .groupBy(*keys)
        .agg(
            *[exact_total(F.col(c)).alias(metric) for metric, c in TOTALS.items()],
            F.count("source_row_hash").alias("record_count"),
            F.count_distinct("supplier_name").alias("unique_suppliers"),
            *[F.count_if(F.col(c)).alias(metric) for metric, c in FLAG_COUNTS.items()],
        )
    )


def mart_base(silver: DataFrame) -> DataFrame:
    """Mergeable partial metrics at the finest grain the marts need.

    One scan and one shuffle of silver; the five marts then roll up this much smaller frame.
    Decimal sums and counts add up exactly, and with the supplier in the grain the distinct
    suppliers of a coarser group are still countable.
    """
    return (
        grouping_text(silver)
        .groupBy(*BASE_KEYS)
        .agg(
            *[exact_part(F.col(c)).alias(f"{metric}_exact") for metric, c in TOTALS.items()],
            *[rest_part(F.col(c)).alias(f"{metric}_rest") for metric, c in TOTALS.items()],
            F.count("source_row_hash").alias("record_count"),
            *[F.count_if(F.col(c)).alias(metric) for metric, c in FLAG_COUNTS.items()],
        )
    )


# Sketches of 2**12 registers: a relative standard error of 1.6 per cent.
SKETCH_SIZE = 12


def sketch_base(silver: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Like :func:`mart_base`, with a mergeable sketch of the suppliers instead of the supplier in
    the grain. The base has one row per group of the mart keys, whatever the number of suppliers;
    ``unique_suppliers`` is then an estimate, which is why the exact base stays the default."""
    keys = [key for key in BASE_KEYS if key != "supplier_name"]
    return (
        grouping_text(silver)
        .groupBy(*keys)
        .agg(
            *[exact_part(F.col(c)).alias(f"{metric}_exact") for metric, c in TOTALS.items()],
            *[rest_part(F.col(c)).alias(f"{metric}_rest") for metric, c in TOTALS.items()],
            F.count("source_row_hash").alias("record_count"),
            F.hll_sketch_agg("supplier_name", F.lit(size)).alias("suppliers"),
            *[F.count_if(F.col(c)).alias(metric) for metric, c in FLAG_COUNTS.items()],
        )
    )


def roll_up_sketches(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The metrics of :func:`group_metrics`, from :func:`sketch_base`; the suppliers are estimated."""
    return base.groupBy(*keys).agg(
        *[
            merge_totals(F.sum(f"{metric}_exact"), F.sum(f"{metric}_rest")).alias(metric)
            for metric in TOTALS
        ],
        F.sum("record_count").alias("record_count"),
        F.hll_sketch_estimate(F.hll_union_agg("suppliers")).alias("unique_suppliers"),
        *[F.sum(metric).alias(metric) for metric in FLAG_COUNTS],
    )


def roll_up(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same result as :func:`group_metrics`, from :func:`mart_base`."""
    return base.groupBy(*keys).agg(
        *[
            merge_totals(F.sum(f"{metric}_exact"), F.sum(f"{metric}_rest")).alias(metric)
            for metric in TOTALS
        ],
        F.sum("record_count").alias("record_count"),
        F.count_distinct("supplier_name").alias("unique_suppliers"),
        *[F.sum(metric).alias(metric) for metric in FLAG_COUNTS],
    )


def _order(spec: MartSpec) -> list[Column]:
    """Sort of a mart, nulls last either way, ties by group key."""
    asked = [
        F.asc_nulls_last(name) if ascending else F.desc_nulls_last(name)
        for name, ascending in spec.sort
    ]
    sorted_names = {name for name, _ in spec.sort}
    return asked + [F.asc_nulls_last(key) for key in spec.keys if key not in sorted_names]


def finish_mart(metrics: DataFrame, spec: MartSpec) -> DataFrame:
    """Filter, sort and cut grouped metrics as the spec asks."""
    kept = metrics.filter(F.col(spec.nonzero) != 0) if spec.nonzero else metrics
    ordered = kept.orderBy(*_order(spec))
    return ordered.limit(spec.top_n) if spec.top_n is not None else ordered


def build_mart(silver: DataFrame, spec: MartSpec) -> DataFrame:
    """One mart straight from silver: only its own columns are scanned."""
    return finish_mart(group_metrics(silver, spec.keys), spec)


def build_sketch_marts(
    silver: DataFrame, base: DataFrame, specs: Sequence[MartSpec] = tuple(MARTS)
) -> dict[str, DataFrame]:
    """All marts from a written :func:`sketch_base`. A mart whose key is the supplier has one
    supplier a row and comes straight from silver, exact."""
    return {
        spec.name: build_mart(silver, spec)
        if "supplier_name" in spec.keys
        else finish_mart(roll_up_sketches(base, spec.keys), spec)
        for spec in specs
    }


def build_marts(base: DataFrame, specs: Sequence[MartSpec] = tuple(MARTS)) -> dict[str, DataFrame]:
    """All marts from the shared base. Write the base first so that it is computed once."""
    return {spec.name: finish_mart(roll_up(base, spec.keys), spec) for spec in specs}

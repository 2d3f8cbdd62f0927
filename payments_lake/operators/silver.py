"""Raw ledger -> silver: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.functions import (
    clean_contract_number,
    clean_numeric,
    clean_text,
    composite_key,
    fiscal_year,
    is_non_profit,
    parse_date,
    parse_timestamp,
    with_row_hash,
    year_month,
)
from payments_lake.schema import (
    AMOUNTS,
    AS_OF,
    BUSINESS_KEY,
    CONTRACT_NUMBER,
    DEPARTMENT,
    DIMENSIONS,
    FILL_VALUE,
    FILLED_CODES,
    FILLED_DIMENSIONS,
    FISCAL_YEAR,
    LARGE_AMOUNTS,
    LOADED_AT,
    PO_DATE,
    RAW_TO_SILVER,
    ROW_HASH,
    SILVER_COLUMNS,
    assert_raw_schema,
)

MISSING_DEPARTMENT = "_raw_department_missing"
NORMALISED = ["department", "supplier_name", "fund_category"]


def cleaned(name: str) -> Column:
    """The silver value of one raw column."""
    c = F.col(name)
    if name == FISCAL_YEAR:
        return fiscal_year(c)
    if name in AMOUNTS:
        return clean_numeric(c)
    if name in (AS_OF, LOADED_AT):
        return parse_timestamp(c)
    if name == PO_DATE:
        return parse_date(c)
    if name == CONTRACT_NUMBER:
        return clean_contract_number(c)
    if name in FILLED_DIMENSIONS or name in FILLED_CODES:
        return clean_text(c, FILL_VALUE)
    if name in DIMENSIONS:
        return clean_text(c)
    return c


def silver_projection(raw: DataFrame) -> DataFrame:
    """Typed and renamed columns, keys over the raw text, and the normalised forms."""
    hashed = with_row_hash(assert_raw_schema(raw))
    typed = hashed.select(
        *[cleaned(name).alias(silver) for name, silver in RAW_TO_SILVER.items()],
        F.col(ROW_HASH),
        composite_key(BUSINESS_KEY).alias("business_composite_key"),
        F.col(DEPARTMENT).isNull().alias(MISSING_DEPARTMENT),
    )
    # Trimmed and filled above; the normalised form only adds the lower case.
    return typed.withColumns({f"{name}_norm": F.lower(name) for name in NORMALISED})


def quality_flags(projected: DataFrame, department_missing: Column | None = None) -> DataFrame:
    """Add the nine flags and the year and month of the order date.

    Without ``department_missing`` the department is tested as it stands, that is after missing
    ones were filled. Comparisons with a null amount give null, not false.
    """
    paid = F.col("vouchers_paid")
    ordered = F.col("purchase_order_date")
    missing = F.col("department").isNull() if department_missing is None else department_missing
    return projected.withColumns(
        {
            "is_missing_department": missing,
            "is_missing_purchase_order_date": ordered.isNull(),
            "is_negative_paid": paid < 0,
            **{f"is_large_paid_{size}": F.abs(paid) > limit for size, limit in LARGE_AMOUNTS.items()},
            "po_year": F.year(ordered),
            "po_month": year_month(ordered),
            "is_fiscal_year_mismatch": ordered.isNotNull()
            & (F.col("fiscal_year") != F.year(ordered)),
            "is_non_profit": is_non_profit(F.col("non_profit_indicator")),
        }
    )


def to_silver(raw: DataFrame, flag_from: str = "filled") -> DataFrame:
    """The 49 silver columns of a raw frame.

    ``flag_from="filled"`` tests for a missing department after the fill, so that flag is never
    set; ``"raw"`` tests the source cell. Stateless, hence usable on a streaming frame as well.
    """
    if flag_from not in ("filled", "raw"):
        raise ValueError(f"flag_from must be 'filled' or 'raw', not {flag_from!r}")
    missing = F.col(MISSING_DEPARTMENT) if flag_from == "raw" else None
    return quality_flags(silver_projection(raw), missing).select(*SILVER_COLUMNS)

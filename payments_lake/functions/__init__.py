"""``Column -> Column`` building blocks; every one is a built-in Spark expression."""

from payments_lake.functions.dates import parse_date, parse_timestamp, year_month
from payments_lake.functions.keys import (
    composite_key,
    normalize_key_value,
    row_hash,
    with_row_hash,
)
from payments_lake.functions.numbers import (
    clean_numeric,
    exact_total,
    fiscal_year,
    fiscal_year_number,
    percent,
    to_double,
)
from payments_lake.functions.text import (
    clean_contract_number,
    clean_text,
    is_non_profit,
    normalize_text,
    nullify_tokens,
    trim_text,
    value_text,
)

__all__ = [
    "clean_contract_number",
    "clean_numeric",
    "clean_text",
    "composite_key",
    "exact_total",
    "fiscal_year",
    "fiscal_year_number",
    "is_non_profit",
    "normalize_key_value",
    "normalize_text",
    "nullify_tokens",
    "parse_date",
    "parse_timestamp",
    "percent",
    "row_hash",
    "to_double",
    "trim_text",
    "value_text",
    "with_row_hash",
    "year_month",
]

"""Column groups of the payments ledger and the Spark types of each layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw column name -> silver column name, in file order.
RAW_TO_SILVER = {
    "Fiscal Year": "fiscal_year",
    "Related Govt Units": "related_govt_units",
    "Organization Group Code": "organization_group_code",
    "Organization Group": "organization_group",
    "Department Code": "department_code",
    "Department": "department",
    "Program Code": "program_code",
    "Program": "program",
    "Character Code": "character_code",
    "Character": "character",
    "Object Code": "object_code",
    "Object": "object",
    "Sub-object Code": "sub_object_code",
    "Sub-object": "sub_object",
    "Fund Type Code": "fund_type_code",
    "Fund Type": "fund_type",
    "Fund Code": "fund_code",
    "Fund": "fund",
    "Fund Category Code": "fund_category_code",
    "Fund Category": "fund_category",
    "Purchase Order": "purchase_order",
    "Supplier & Other Non-Supplier Payees": "supplier_name",
    "Vouchers Paid": "vouchers_paid",
    "Vouchers Pending": "vouchers_pending",
    "Encumbrance Balance": "encumbrance_balance",
    "Vouchers Pending Retainage": "vouchers_pending_retainage",
    "data_as_of": "data_as_of",
    "data_loaded_at": "data_loaded_at",
    "Non-Profit Indicator": "non_profit_indicator",
    "Contract Number": "contract_number",
    "Contract Title": "contract_title",
    "Purchase Order Date": "purchase_order_date",
    "Purchasing Authority Description": "purchasing_authority_description",
}

RAW_COLUMNS = list(RAW_TO_SILVER)

FISCAL_YEAR = "Fiscal Year"
DEPARTMENT = "Department"
PURCHASE_ORDER = "Purchase Order"
SUPPLIER = "Supplier & Other Non-Supplier Payees"
CONTRACT_NUMBER = "Contract Number"
PO_DATE = "Purchase Order Date"
AS_OF = "data_as_of"
LOADED_AT = "data_loaded_at"
INDICATOR = "Non-Profit Indicator"

# The column groups that the rules refer to.
AMOUNTS = [
    "Vouchers Paid",
    "Vouchers Pending",
    "Encumbrance Balance",
    "Vouchers Pending Retainage",
]
DATES = [AS_OF, LOADED_AT, PO_DATE]
CRITICAL = [FISCAL_YEAR, PURCHASE_ORDER, SUPPLIER, "Vouchers Paid", AS_OF, LOADED_AT]
CRITICAL_FOR_TYPES = [
    FISCAL_YEAR,
    DEPARTMENT,
    PURCHASE_ORDER,
    SUPPLIER,
    "Vouchers Paid",
    AS_OF,
    LOADED_AT,
    PO_DATE,
]
WARNING = [DEPARTMENT, PO_DATE, "Encumbrance Balance"]
DIMENSIONS = [
    "Organization Group",
    "Department",
    "Program",
    "Character",
    "Object",
    "Sub-object",
    "Fund Type",
    "Fund",
    "Fund Category",
    SUPPLIER,
    INDICATOR,
    "Purchasing Authority Description",
]
BUSINESS_KEY = [
    FISCAL_YEAR,
    "Department Code",
    "Program Code",
    "Character Code",
    "Object Code",
    "Sub-object Code",
    "Fund Code",
    PURCHASE_ORDER,
    SUPPLIER,
    CONTRACT_NUMBER,
]
FILLED_DIMENSIONS = ["Department", "Program", "Fund Category", "Purchasing Authority Description"]
FILLED_CODES = ["Department Code", "Program Code", "Character Code", "Object Code", "Fund Code"]
KEY_CANDIDATES = {
    "purchase_order": [PURCHASE_ORDER],
    "purchase_order_supplier": [PURCHASE_ORDER, SUPPLIER],
    "fiscal_year_purchase_order_supplier": [FISCAL_YEAR, PURCHASE_ORDER, SUPPLIER],
    "fiscal_year_department_purchase_order_supplier": [
        FISCAL_YEAR,
        DEPARTMENT,
        PURCHASE_ORDER,
        SUPPLIER,
    ],
    "business_composite_key": BUSINESS_KEY,
}

# Paid amounts strictly above these sizes are flagged.
LARGE_AMOUNTS = {"1m": 1e6, "10m": 1e7, "100m": 1e8, "1b": 1e9}

FILL_VALUE = "Unknown"

# Columns that landing adds next to the 33 source columns.
ROW_ID = "_row_id"
ROW_HASH = "source_row_hash"
CORRUPT_RECORD = "_corrupt_record"
WIDTH = "_width"
LANDING_COLUMNS = [ROW_ID, ROW_HASH, CORRUPT_RECORD, WIDTH]

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

FLAGS = [
    "is_missing_department",
    "is_missing_purchase_order_date",
    "is_negative_paid",
    "is_large_paid_1m",
    "is_large_paid_10m",
    "is_large_paid_100m",
    "is_large_paid_1b",
    "is_fiscal_year_mismatch",
    "is_non_profit",
]

_SILVER_TYPES = {
    "fiscal_year": T.IntegerType(),
    **{RAW_TO_SILVER[name]: T.DoubleType() for name in AMOUNTS},
    "data_as_of": T.TimestampNTZType(),
    "data_loaded_at": T.TimestampNTZType(),
    "purchase_order_date": T.DateType(),
    "po_year": T.IntegerType(),
    **{flag: T.BooleanType() for flag in FLAGS},
}
SILVER_COLUMNS = [
    *RAW_TO_SILVER.values(),
    ROW_HASH,
    "business_composite_key",
    "department_norm",
    "supplier_name_norm",
    "fund_category_norm",
    *FLAGS[:7],
    "po_year",
    "po_month",
    *FLAGS[7:],
]
SILVER_SCHEMA = T.StructType(
    [T.StructField(name, _SILVER_TYPES.get(name, T.StringType())) for name in SILVER_COLUMNS]
)

# The silver columns that a valid output must have.
REQUIRED_SILVER_COLUMNS = [
    ROW_HASH,
    "business_composite_key",
    "fiscal_year",
    "department",
    "department_norm",
    "purchase_order",
    "supplier_name",
    "supplier_name_norm",
    "vouchers_paid",
    "vouchers_pending",
    "encumbrance_balance",
    "vouchers_pending_retainage",
    "data_as_of",
    "data_loaded_at",
    "purchase_order_date",
    "po_year",
    "po_month",
    *FLAGS,
]


def source_columns(raw: DataFrame) -> list[str]:
    """Columns of a raw frame without the ones landing added."""
    return [name for name in raw.columns if name not in LANDING_COLUMNS]


def assert_raw_schema(raw: DataFrame) -> DataFrame:
    """Fail unless the source columns are exactly the expected ones, in order."""
    actual = source_columns(raw)
    if actual != RAW_COLUMNS:
        raise ValueError(
            "Raw columns differ from the expected schema: "
            f"missing={[c for c in RAW_COLUMNS if c not in actual]}, "
            f"extra={[c for c in actual if c not in RAW_COLUMNS]}"
        )
    return raw

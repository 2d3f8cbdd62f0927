"""Fixed values, pinned literally: the SQL side shares the lists, so a wrong one would agree with itself."""

from payments_lake import schema
from payments_lake.functions.text import MISSING_TOKENS
from payments_lake.operators.dimensions import SPECIAL_VALUES


def test_missing_tokens():
    assert set(MISSING_TOKENS) == {
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
        "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    }


def test_special_values():
    assert SPECIAL_VALUES == [
        "Unknown", "UNKNOWN", "Other", "OTHER", "Direct Payments", "N/A", "NA", "None", "NULL", "",
    ]


def test_column_groups():
    supplier = "Supplier & Other Non-Supplier Payees"
    business = [
        "Fiscal Year", "Department Code", "Program Code", "Character Code", "Object Code",
        "Sub-object Code", "Fund Code", "Purchase Order", supplier, "Contract Number",
    ]
    assert schema.BUSINESS_KEY == business
    assert schema.KEY_CANDIDATES == {
        "purchase_order": ["Purchase Order"],
        "purchase_order_supplier": ["Purchase Order", supplier],
        "fiscal_year_purchase_order_supplier": ["Fiscal Year", "Purchase Order", supplier],
        "fiscal_year_department_purchase_order_supplier": [
            "Fiscal Year", "Department", "Purchase Order", supplier,
        ],
        "business_composite_key": business,
    }
    assert schema.WARNING == ["Department", "Purchase Order Date", "Encumbrance Balance"]
    assert schema.LARGE_AMOUNTS == {"1m": 1e6, "10m": 1e7, "100m": 1e8, "1b": 1e9}
    assert len(schema.RAW_COLUMNS) == 33

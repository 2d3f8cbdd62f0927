"""Text cleaning as ``Column -> Column`` functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from payments_lake.schema import FILL_VALUE

# Cell texts that count as missing when a file is read.
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
LONGEST_TOKEN = max(len(token.encode()) for token in MISSING_TOKENS)

# Every character that counts as white space at the edge of a cell.
WHITESPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Texts without white space but blanks; rarer scripts are left out, as a text may fail to match.
ONLY_BLANKS = r"^[ -~\u00a1-\u167f]*\z"

# Texts that mean "no contract" once trimmed.
MISSING_CONTRACTS = ["nan", "NaN", "<NA>"]

NULL_KEY = "<NULL>"


def nullify_tokens(c: Column) -> Column:
    """Null for the cell texts that stand for a missing value. Applied before trimming.

    Most cells are longer than any of these texts and need not be looked up.
    """
    return F.when(~((F.octet_length(c) <= LONGEST_TOKEN) & c.isin(MISSING_TOKENS)), c)


def trim_text(c: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column, fill: str | None = None) -> Column:
    """Trim; optionally replace null (not blank) by ``fill``."""
    trimmed = trim_text(c)
    return trimmed if fill is None else F.coalesce(trimmed, F.lit(fill))


def normalize_text(c: Column, fill: str | None = None) -> Column:
    """Trimmed lower-case form for grouping and search."""
    return F.lower(clean_text(c, fill))


def clean_contract_number(c: Column) -> Column:
    """Contract number as an id: trimmed, without one trailing ``.0``."""
    trimmed = trim_text(c)
    return F.when(~trimmed.isin(MISSING_CONTRACTS), F.regexp_replace(trimmed, r"\.0$", ""))


def is_non_profit(c: Column) -> Column:
    """True when the (already trimmed) indicator is an x of either case."""
    return F.upper(F.coalesce(c, F.lit(""))) == "X"


def value_text(c: Column) -> Column:
    """A cell as a countable value: null counts as the value ``<NULL>``."""
    return F.coalesce(c, F.lit(NULL_KEY))


__all__ = [
    "FILL_VALUE",
    "MISSING_TOKENS",
    "NULL_KEY",
    "WHITESPACE",
    "clean_contract_number",
    "clean_text",
    "is_non_profit",
    "normalize_text",
    "nullify_tokens",
    "trim_text",
    "value_text",
]

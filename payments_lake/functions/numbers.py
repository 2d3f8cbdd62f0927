"""Numeric parsing and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from payments_lake.functions.text import trim_text

# A plain number, or infinity spelled out. The JVM would also read "1d", "NaN" and hex.
NUMBER_PATTERN = (
    r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf(?:inity)?))\s*$"
)
# Money as it is usually written: digits with separators, at most in one pair of brackets.
USUAL_MONEY = r"^\s*(?:\([0-9.,$+\-\s]*\)|[0-9.,$+\-\s]*)\s*$"
# Characters of money that is surely below the largest double.
SURELY_FINITE = 300
# A year as it is usually written.
USUAL_YEAR = r"^[0-9]{1,15}\z"
INFINITY = float("inf")


def to_double(c: Column) -> Column:
    """Text as a double, or null. A number too large for a double is null as well, a
    spelled-out infinity is kept."""
    value = F.regexp_extract(c, NUMBER_PATTERN, 0).try_cast("double")
    return F.when((F.abs(value) < INFINITY) | F.lower(c).contains("inf"), value)


def clean_numeric(c: Column) -> Column:
    """Money text as a double: drops ``,`` and ``$``, reads ``(x)`` as ``-x``.

    The usual form needs one pass over its characters; any other form is taken apart.
    """
    short = F.translate(c, "(,$)", "-").try_cast("double")
    usual = F.when(F.abs(short) < INFINITY, short)  # more digits than a double can hold
    digits = F.translate(trim_text(c), ",$", "")
    other = to_double(F.regexp_replace(digits, r"^\((.*)\)$", "-$1"))
    is_usual = c.rlike(USUAL_MONEY)
    # A value that is tested is parsed twice, so a text too short to be infinite is not.
    return (
        F.when(is_usual & (F.octet_length(c) < SURELY_FINITE), short)
        .when(is_usual, usual)
        .otherwise(other)
    )


def fiscal_year_number(c: Column) -> Column:
    """Fiscal year as the number it spells, whole or not; null where it spells none."""
    return F.when(c.rlike(USUAL_YEAR), c.try_cast("double")).otherwise(to_double(trim_text(c)))


def fiscal_year(c: Column) -> Column:
    """Fiscal year as an integer; null where the text is not a whole number."""
    number = fiscal_year_number(c)
    return F.when(number == F.floor(number), number.try_cast("int"))


def year_label(number: Column) -> Column:
    """Text of a fiscal year number: ``2019`` for whole years, ``2019.5`` otherwise."""
    return F.when(number == F.floor(number), number.try_cast("bigint").cast("string")).otherwise(
        number.cast("string")
    )


def exact_total(c: Column) -> Column:
    """Sum of a double column; 0 for no values.

    Each value is split in two: a decimal with six places, whose sums are exact, so partial sums
    agree in any row order and opposite entries cancel to zero; and what the decimal leaves over,
    which is zero for money and is added as doubles. Values that no decimal can hold, infinities
    included, are left over whole. No digit is dropped, whatever the size.
    """
    return merge_totals(exact_part(c), rest_part(c))


def _in_decimal(c: Column) -> Column:
    return F.coalesce(c.try_cast("decimal(24,6)"), F.lit(0).cast("decimal(24,6)"))


def exact_part(c: Column) -> Column:
    """The exact decimal part of :func:`exact_total`, mergeable across partial groups."""
    return F.sum(_in_decimal(c))


def rest_part(c: Column) -> Column:
    """The double part of :func:`exact_total`: what the decimals leave over."""
    return F.sum(c - _in_decimal(c).cast("double"))


def merge_totals(exact: Column, rest: Column) -> Column:
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent with four decimals; 0 when there is nothing to share."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, 4)).otherwise(F.lit(0.0))

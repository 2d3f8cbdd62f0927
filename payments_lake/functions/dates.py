"""Date and timestamp parsing, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The end is the very end: a dollar sign would also match before a last line break.
DATE_PATTERN = r"^\d{4}/\d{1,2}/(?:\d{1,2}| \d)\z"
TIMESTAMP_PATTERN = (
    r"^\d{4}/\d{1,2}/(?:\d{1,2}| \d) (?:0?[1-9]|1[0-2]):\d{1,2}:\d{1,2} [AaPp][Mm]\z"
)


def _iso_day(c: Column) -> Column:
    """``2018/8/ 7`` as ``2018-8-07``: the separators and the padding of ISO dates."""
    return F.replace(F.replace(c, F.lit("/"), F.lit("-")), F.lit("- "), F.lit("-0"))


def parse_date(c: Column) -> Column:
    """``yyyy/M/d`` text as a date, or null."""
    return F.when(c.rlike(DATE_PATTERN), _iso_day(c).try_cast("date"))


def parse_timestamp(c: Column) -> Column:
    """``yyyy/M/d h:m:s AM|PM`` text as a timestamp without time zone, or null."""
    spaced = F.regexp_replace(c, r"(\d)\s+", "$1 ")
    moment = F.when(c.rlike(TIMESTAMP_PATTERN), _twelve_hour(c)).when(
        spaced.rlike(TIMESTAMP_PATTERN), _twelve_hour(spaced)
    )
    # Hours run 12, 1, 2, .. 11: half a day is added after noon and taken off at twelve.
    afternoon = F.substring(c, -2, 1).isin("P", "p").cast("int")
    twelve = c.rlike(r"\s12:").cast("int")
    return moment + F.expr("interval '12' hour") * (afternoon - twelve)


def _twelve_hour(c: Column) -> Column:
    """The moment without its AM or PM."""
    return _iso_day(c.substr(F.lit(1), F.length(c) - 3)).try_cast("timestamp_ntz")


def year_month(c: Column) -> Column:
    """``yyyy-MM`` of a date or timestamp."""
    return F.substring(c.cast("string"), 1, 7)

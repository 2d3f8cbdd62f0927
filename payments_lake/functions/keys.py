"""Row identity and business keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.functions.text import NULL_KEY, ONLY_BLANKS, trim_text
from payments_lake.schema import ROW_HASH, source_columns

SEPARATOR = "||"


def normalize_key_value(c: Column) -> Column:
    """One part of a key: trimmed text, null spelled out."""
    return F.coalesce(trim_text(c), F.lit(NULL_KEY))


def composite_key(columns: Sequence[str]) -> Column:
    """Key text over several columns.

    Looking for white space of any kind at both ends of every cell is costly. Where the whole text
    has none but blanks, cutting blanks off is all there is to do; the text is tested once.
    """
    blanks_cut = F.concat_ws(
        SEPARATOR, *[F.coalesce(F.btrim(F.col(name)), F.lit(NULL_KEY)) for name in columns]
    )
    # No element where the pattern fails. A condition would evaluate the text twice.
    plain = F.get(F.regexp_extract_all(blanks_cut, F.lit(ONLY_BLANKS), F.lit(0)), F.lit(0))
    return F.coalesce(
        plain, F.concat_ws(SEPARATOR, *[normalize_key_value(F.col(name)) for name in columns])
    )


def row_hash(columns: Sequence[str]) -> Column:
    """32 hex digits that identify the content of a row."""
    return F.md5(composite_key(columns))


def with_row_hash(raw: DataFrame) -> DataFrame:
    """Add the row hash over the source columns, unless landing stored it already."""
    if ROW_HASH in raw.columns:
        return raw
    return raw.withColumn(ROW_HASH, row_hash(source_columns(raw)))

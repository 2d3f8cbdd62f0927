"""Scans and sinks."""

from payments_lake.sources.bridge import bridge, raw_table
from payments_lake.sources.lake import read_silver, read_table, write_silver, write_table
from payments_lake.sources.raw_csv import (
    field_count,
    file_sizes,
    files_that_span_lines,
    land_raw,
    parse_records,
    permissive_scan,
    raw_scan,
    read_landed,
)

__all__ = [
    "bridge",
    "field_count",
    "file_sizes",
    "files_that_span_lines",
    "land_raw",
    "parse_records",
    "permissive_scan",
    "raw_scan",
    "raw_table",
    "read_landed",
    "read_silver",
    "read_table",
    "write_silver",
    "write_table",
]

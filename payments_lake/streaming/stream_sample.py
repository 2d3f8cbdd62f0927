"""The sample that a streaming consumer replays, raw and in silver form.

Producing it is a batch job. The silver transform is stateless, so the consumer may also apply
``to_silver`` to a streaming frame of raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from payments_lake.operators.sampling import SEED, simple_sample
from payments_lake.operators.silver import to_silver
from payments_lake.schema import ROW_ID

STREAM_SAMPLE_ROWS = 100_000


def stream_sample(
    raw: DataFrame, n: int = STREAM_SAMPLE_ROWS, seed: int = SEED, row_id: str = ROW_ID
) -> DataFrame:
    """Up to ``n`` raw rows."""
    return simple_sample(raw, n, seed, row_id)


def silver_stream_sample(
    raw: DataFrame, n: int = STREAM_SAMPLE_ROWS, seed: int = SEED, row_id: str = ROW_ID
) -> DataFrame:
    """The same rows in silver form."""
    return to_silver(stream_sample(raw, n, seed, row_id))

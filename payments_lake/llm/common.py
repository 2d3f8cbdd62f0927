"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The white space that separates words, as the body of a character class.
SPACE = r"\x20\x09-\x0D"


def with_package(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The same function, after making sure that Python workers on this machine can import the
    library. On other machines it is installed, or sent with ``--py-files``, as usual."""

    @wraps(work)
    def run(spark: SparkSession, *rest) -> DataFrame:
        root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            known["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return work(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir``.

    Only where that setting is missing and driver and executors are one process, as in tests, a
    temporary folder serves; anywhere else its files would be missing on the other machines.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="llm-shared-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, its lineage cut, and
    readable after the loss of any executor."""
    path = f"{shared_folder(frame.sparkSession)}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def most_frequent(counts: DataFrame, most: int) -> list:
    """The rows of ``counts`` (with a column n) from the lowest n on at which no more than ``most``
    rows remain, most frequent first.

    The rows per n are counted first, large n by ranges of a third of a per cent; there are at most
    about 14,000 such ranges. Only the rows wanted come to the driver, not the best of every task.
    """
    kept = written(counts, "counts")
    n = F.col("n")
    ranges = F.when(n < 1000, n).otherwise(1000 + F.floor(200 * F.log2(n / 1000))).cast("long")
    sizes = kept.groupBy(ranges.alias("range")).count().collect()
    total, lowest = 0, None
    for row in sorted(sizes, key=lambda r: -r["range"]):
        total += row["count"]
        if total > most:
            break
        lowest = row["range"]
    if lowest is None:
        return []
    rows = kept.filter(ranges >= lowest).collect()
    return sorted(rows, key=lambda r: (-r.n, *(r[c] for c in kept.columns if c != "n")))


def lower_ascii(c: Column) -> Column:
    """Lower-cases A to Z and no other letter."""
    return F.translate(c, UPPER, UPPER.lower())


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))

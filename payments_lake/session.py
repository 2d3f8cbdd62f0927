"""Session settings that suit the jobs of this library."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # The silver projection is wide. The JVM does not compile methods above 8,000 bytes, so
    # beyond that size separate small methods are faster than one generated loop.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Joins of skewed keys, uneven partitions and small tasks are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session. Results do not depend on them."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark

"""A session with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps timestamps comparable; AQE coalesces small and splits skewed partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "strataforge", master: str | None = None, **settings: str) -> SparkSession:
    """A session; on a cluster master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

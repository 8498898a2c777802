"""Session settings the operators are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that differ from Spark's defaults, or matter if changed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets the terms of a search reach the scan of a stored index one by one.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Vectors pass through Python in batches of this many rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # ... and at most so many bytes, for file payloads and long texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder

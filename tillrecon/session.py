"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: coalesce small partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dates and months must not depend on where the cluster stands.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method above 8000 bytes of code; generated code of that size would be
    # interpreted for good, so such a stage is better off without whole-stage generation.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def with_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

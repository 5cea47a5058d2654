"""Session settings for large runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configured(builder: SparkSession.Builder, total_cores: int) -> SparkSession.Builder:
    """Settings that the jobs of this library rely on or profit from.

    The shuffle starts wide, three tasks per core, and is coalesced at run time.
    Read splits are small because parsing XML is bound by CPU, not by bytes.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(3 * total_cores),
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.files.maxPartitionBytes": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder

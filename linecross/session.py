"""Session settings that suit the package's joins."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: A pair join makes many candidates from few bytes, so small partitions are worth a task of their own.
#: The smallest size is a floor; the advisory one keeps what a task sorts, several times its shuffled bytes, in memory.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.files.openCostInBytes": "65536",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

"""Session settings for large tables. Any Spark session works; these are the ones to start from."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed values. Shuffle partitions are an upper bound: adaptive execution joins small ones and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.scheduler.mode": "FAIR",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build(name: str, checkpoint_dir: str, **overrides: str) -> SparkSession:
    """A session with these settings. ``checkpoint_dir`` must be a folder that all executors share."""
    builder = SparkSession.builder.appName(name).config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

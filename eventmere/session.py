"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results: days are cut in UTC and bad input must not pass
# silently through a plain cast.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Shuffle partitions start high and AQE merges them down to the advisory size,
# so one setting serves both a small batch and a full scan. Skewed join
# partitions are split by AQE; the jobs keep hot keys on a side it can split.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def cluster_session(app_name: str = "eventmere", settings: dict[str, str] | None = None) -> SparkSession:
    """Session for a large cluster; master and checkpoint folder come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RESULT_SETTINGS, **SCALE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(
    cores: str = "8", app_name: str = "eventmere-local", settings: dict[str, str] | None = None
) -> SparkSession:
    """Small session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in {**RESULT_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Cut days in UTC in a session this package did not build."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: adaptive execution coalesces, re-plans joins by measured size and splits
#: skewed partitions; ANSI mode turns silent overflow into an error. The size of
#: compressed files says little, so on it only small tables are broadcast; at run
#: time the measured size decides, and dimensions are projected to a key and an id
#: before a join, so 64 MB is some million members
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str | int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("matchmart")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

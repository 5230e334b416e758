"""Session settings that the operators rely on: UTC, AQE with skew joins, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def builder(app: str) -> SparkSession.Builder:
    """A builder with the settings; master, memory and shuffle partitions are the deployment's."""
    out = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out


def local_session(app: str, cores: int = 8, partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A single-process session for tests and benchmarks."""
    session = (
        builder(app)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session

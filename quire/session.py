"""Sessions with the settings that the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution re-plans joins and splits skewed partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local(app: str = "quire", cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster, pass SETTINGS to the session at hand."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.sql.shuffle.partitions", partitions)
    return builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config(map=SETTINGS).getOrCreate()

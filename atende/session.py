"""Session settings that the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins by the sizes seen at run time and splits skewed
# partitions; the session time zone fixes how event-time text is read.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster, pass SETTINGS to spark-submit."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("atende")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

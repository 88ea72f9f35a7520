"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps text dates and epoch seconds the same on every machine; AQE coalesces small shuffles,
# splits skewed joins and re-plans join strategies from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call-site capture for error messages costs more than planning for wide expressions.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def local(cpus: int | str = 8, partitions: int = 8, app: str = "sparkmart") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = configure(SparkSession.builder.master(f"local[{cpus}]").appName(app))
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )

"""Session factory with the settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution does partition coalescing and skew-join splitting; Arrow batches are bounded because texts can be long.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "corpusloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the engine's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:  # else that of spark-submit, or Spark's default, local[*]
        builder = builder.master(master)
    for key, value in (DEFAULTS | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

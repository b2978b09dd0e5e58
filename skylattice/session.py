"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Parquet timestamps carry no zone, so the zone is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits hot partitions of the shuffled joins (see operators.proximity).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs more than planning on small inputs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "skylattice", master: str | None = None, **settings) -> SparkSession:
    """Build (or fetch) a session; ``settings`` use ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()

"""Session settings the reports are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins and partition sizes follow measured sizes; hot keys are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # One scan and shuffle for all readers of a group statistic.
    "spark.sql.exchange.reuse": "true",
    # A sum that overflows fails instead of turning NULL.
    "spark.sql.ansi.enabled": "true",
    # No stack trace per column expression: halves the time to build a plan.
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session_builder(app_name: str = "wardstats") -> SparkSession.Builder:
    """A builder with these settings; the cluster sets master, memory and cores."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder

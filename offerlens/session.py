"""Session settings the jobs are written for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
}


def builder(app_name: str = "offerlens") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        made = made.config(key, value)
    return made

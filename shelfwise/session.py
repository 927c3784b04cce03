"""Session settings the library is tuned for. Any session works; these make it fast."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Joins and shuffles are planned from sizes seen at run time; hot keys are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The joined lines are written in two halves; two open files per task spare a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # The JVM does not compile methods above 8000 bytes; split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # No Python stack trace per column expression: plans with many rules build faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def builder(app: str) -> SparkSession.Builder:
    settings = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        settings = settings.config(key, value)
    return settings

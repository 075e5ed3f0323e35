"""A session with the settings this engine is written for; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE splits skewed joins and merges small partitions; the rest keeps results the same everywhere.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def session(app: str = "tamarack", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

"""A Spark session with the settings that the engine counts on; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "colloquy", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

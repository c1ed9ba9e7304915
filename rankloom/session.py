"""Session defaults: UTC, adaptive plans. Cluster settings stay the cluster's."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(name: str = "rankloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

"""Parsed tables kept by the digests of their inputs."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def cached(spark: SparkSession, folder: str, digests: list[str], compute: Callable[[], DataFrame]) -> DataFrame:
    """The table kept for exactly these digests, in this order; else it is computed and kept. A table counts only when
    its writing has ended, so one broken off is made anew."""
    key = hashlib.sha256("\n".join(digests).encode()).hexdigest()
    path = f"{folder.rstrip('/')}/{key}"
    jvm = spark._jvm
    done = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

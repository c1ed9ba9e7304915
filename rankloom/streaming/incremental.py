"""The merge operators as micro-batches of a stream: exactly once by batch number, state as Parquet versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def keep_merged(stream: DataFrame, state_path: str, checkpoint: str, merge: Callable[[DataFrame, DataFrame], DataFrame], empty: DataFrame):
    """Starts a query that handles all there is and stops. Each batch n reads the state of the newest batch before n and
    writes version n; a batch that is run again after a failure writes the same version from the same state."""
    spark = stream.sparkSession

    def step(batch: DataFrame, n: int) -> None:
        before = [v for v in _versions(spark, state_path) if v < n]
        state = spark.read.schema(empty.schema).parquet(f"{state_path}/v={max(before)}") if before else empty
        merge(state, batch).write.mode("overwrite").parquet(f"{state_path}/v={n}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark, state_path: str, empty: DataFrame) -> DataFrame:
    done = _versions(spark, state_path)
    return spark.read.schema(empty.schema).parquet(f"{state_path}/v={max(done)}") if done else empty


def _versions(spark, path: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    done = [s.getPath() for s in fs.listStatus(p) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return [int(x.getName()[2:]) for x in done if x.getName().startswith("v=")]

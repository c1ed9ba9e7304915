"""Intermediate tables in the folder that every executor shares."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a temporary folder serves as long as driver and executors are one
    process; on a cluster that would be a folder that others don't see, so it is an error."""
    given = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="rankloom-")
    return _own[app]


@contextmanager
def _freeing(spark: SparkSession):
    """Shuffle files of a job that ends in a table are of no further use; let Spark remove them with it."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class Scratch:
    """Writes tables and reads them back, which cuts lineage. Tables go when the caller drops them; those that a
    returned plan still reads go with the application."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._n, self._paths = 0, set()
        fs, path = self._at(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n}-{name}"
        with _freeing(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._rankloom_path = path
        self._paths.add(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t._rankloom_path)

    def keep_only(self, *tables: DataFrame) -> None:
        """Drops all tables but these, which a returned plan still reads."""
        for path in self._paths - {t._rankloom_path for t in tables}:
            self._delete(path)

    def drop_all(self) -> None:
        self._delete(self.root)

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
        self._paths.discard(path)

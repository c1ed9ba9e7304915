"""Makes this package importable on executors, wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_done: set[str] = set()

#: Bytes of an Arrow batch, where the session has Spark's own 64 MiB: an executor holds several batches for each core,
#: in the JVM and in Python, and texts in them are unpacked there.
BATCH_KEY, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 8 << 20


def ship(spark: SparkSession) -> None:
    """Once for each application: Spark's own file service hands the package to every executor, also to new ones."""
    app = spark.sparkContext.applicationId
    if app in _done:
        return
    _done.add(app)
    if spark.conf.get(BATCH_KEY, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    package = Path(__file__).resolve().parents[0]
    name = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="rankloom-")), "rankloom_package.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in package.rglob("*.py"):
            z.write(p, Path(package.name) / p.relative_to(package))
    spark.sparkContext.addPyFile(name)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)

"""State in partitions with versions: a change writes the partitions that it touches, and one rename makes it valid."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PART = "__part"


class PartitionedState:
    """A folder with data/<version>/<partition> and versions/<number>, which lists the folders that a version consists of.

    replace() writes the batch's partitions anew and lists the others where they are, so their files stay untouched and
    readers of older versions are not disturbed. What a failed run wrote is in no list, and the next run writes over it.
    Two writers that begin from one version cannot both end: the second rename fails. Lists have a line for each
    partition, so partitions are to be few against rows (a body, a year, a bucket of keys)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, partition: Column):
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), StructType.fromDDL(schema), partition

    def version(self) -> int:
        """The newest version, 0 before the first."""
        return max((int(n) for n in self._names(f"{self.path}/versions") if n.isdigit()), default=0)

    def folders(self, version: int | None = None) -> dict[str, str]:
        """Partition (as text) -> folder, relative to the path; tables kept beside under their name with a leading '/'."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(self._open(f"{self.path}/versions/{version}"), "UTF-8"))

    def read(self, version: int | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows of a version, of some partitions only where they are named."""
        mine = {k: v for k, v in self.folders(version).items() if not k.startswith("/") and (only is None or k in only)}
        if not mine:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in mine.values()])

    def beside(self, name: str, schema: str, version: int | None = None) -> DataFrame:
        """A table that was kept beside with replace()."""
        folder = self.folders(version).get(f"/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}") if folder else self.spark.createDataFrame([], schema)

    def touched(self, batch: DataFrame) -> list[str]:
        """Partitions that the batch has rows of."""
        return sorted(r[0] for r in batch.select(self.partition.cast("string").alias("p")).distinct().collect())

    def replace(self, batch: DataFrame, beside: dict[str, DataFrame] | None = None, emptied: list[str] = ()) -> int:
        """The next version: partitions that the batch has (or that are named as emptied) hold the batch's rows only.
        Tables in beside become valid with it. Rows of a null partition are an error."""
        n = self.version() + 1
        folders = {k: v for k, v in self.folders(n - 1).items() if k not in emptied}
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        key = F.coalesce(self.partition.cast("string"), F.raise_error("a row without a partition").cast("string"))
        named = batch.select(*columns, F.concat(F.lit("p"), F.hex(F.encode(key, "UTF-8"))).alias(_PART))
        named.write.mode("overwrite").partitionBy(_PART).option("compression", "zstd").parquet(f"{self.path}/data/{n}")
        for folder in self._names(f"{self.path}/data/{n}"):
            if folder.startswith(f"{_PART}=p"):
                folders[bytes.fromhex(folder.removeprefix(f"{_PART}=p")).decode()] = f"data/{n}/{folder}"
        for name, df in (beside or {}).items():
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/beside/{name}/{n}")
            folders[f"/{name}"] = f"beside/{name}/{n}"
        self._commit(n, folders)
        return n

    def drop_before(self, version: int) -> None:
        """Deletes folders that no version from this one on lists, and the lists before it."""
        fs = self._fs()
        listed = {f for n in range(version, self.version() + 1) for f in self.folders(n).values()}
        for n in self._names(f"{self.path}/versions"):
            if n.isdigit() and int(n) < version:
                for folder in set(self.folders(int(n)).values()) - listed:
                    fs.delete(self._path(f"{self.path}/{folder}"), True)
                fs.delete(self._path(f"{self.path}/versions/{n}"), True)

    def _commit(self, n: int, folders: dict[str, str]) -> None:
        fs, waiting = self._fs(), f"{self.path}/versions/_{uuid.uuid4().hex}"
        out = fs.create(self._path(waiting), True)
        try:
            out.write(bytearray(json.dumps(folders).encode()))
        finally:
            out.close()
        final = self._path(f"{self.path}/versions/{n}")
        if fs.exists(final) or not fs.rename(self._path(waiting), final):
            fs.delete(self._path(waiting), False)
            raise RuntimeError(f"version {n} was written by another run")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _open(self, path: str):
        return self._fs().open(self._path(path))

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(), self._path(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


class DocumentTotals:
    """Totals of documents that may be corrected, kept by signed changes.

    A batch's documents replace those of their url: the rows of the old ones are taken off the totals and the new ones'
    added, so a correction reads its own documents' buckets and the totals, never the other documents. Totals carry the
    number of rows that they come from; a key goes with its last row. Documents and totals become valid together."""

    def __init__(self, spark: SparkSession, path: str, schema: str, url: str, order: list[str], keys: list[str], count: str, buckets: int = 64):
        self.url, self.order, self.keys, self.count = url, order, keys, count
        self.state = PartitionedState(spark, path, schema, F.pmod(F.xxhash64(url), F.lit(buckets)))
        fields = {f.name: f.dataType.simpleString() for f in self.state.schema.fields}
        self.totals_schema = ", ".join(f"{k} {fields[k]}" for k in keys) + ", n_rows long, total long"

    def totals(self, version: int | None = None) -> DataFrame:
        """keys, n_rows, total."""
        return self.state.beside("totals", self.totals_schema, version)

    def changes(self, batch: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        """The batch's latest documents; rows with a sign, old ones -1 and new ones 1; the buckets that they are in."""
        newest = batch.groupBy(self.url).agg(F.max(F.struct(*self.order)).alias("__o"))
        latest = batch.join(newest, self.url).filter(F.struct(*self.order) == F.col("__o")).select(*self.state.schema.fieldNames())
        buckets = self.state.touched(latest)
        old = self.state.read(only=buckets).join(latest.select(self.url).distinct(), self.url, "left_semi")
        return latest, latest.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1))), buckets

    def apply(self, batch: DataFrame) -> int:
        """Takes in a batch; the new version's number. A document counts as a whole: its rows share url and order."""
        latest, signed, buckets = self.changes(batch)
        # Summed over the changes before they meet the totals.
        delta = signed.groupBy(*self.keys).agg(F.sum("sign").alias("n_rows"), F.sum(F.col("sign") * F.coalesce(self.count, F.lit(0))).cast("long").alias("total"))
        after = self.totals().unionByName(delta).groupBy(*self.keys).agg(F.sum("n_rows").alias("n_rows"), F.sum("total").alias("total")).filter("n_rows > 0")
        rest = self.state.read(only=buckets).join(latest.select(self.url).distinct(), self.url, "left_anti").select(*latest.columns)
        return self.state.replace(rest.unionByName(latest), beside={"totals": after})

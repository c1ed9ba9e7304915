"""Exact deduplication by a stream over keyed state on disk, in DataFrame and SQL functions only.

A log of rows (digest of the normalised text, doc_id, content locator: file and row number in it) feeds a streaming
aggregate whose state lives in RocksDB, checkpointed in the shared folder and without any expiry: for each digest it
retains the least identifier, that row's locator and the number of rows. Each log file is taken in once, so later
documents may be added at any time and a stopped run goes on where it stopped. Tasks aggregate before rows are
shuffled, so a digest that holds a third of all rows sends one row a task.

The state is read back as a table. Digests of more than one row are hits: their rows' whole texts are fetched by
locator and grouped by digest and text (in each task first), and where a digest turns out to hold several texts, its
rows are decided by text instead. So a result never rests on digests alone. Rows meet the state on the digest; the
digests that hold a thousandth of all rows or more, a thousand at most, are met by broadcast, so that no hot key is
left in the shuffle.

Defined cases: texts are compared with each run of white space [\\x20\\x09-\\x0D] as one space; null counts as empty.
Of equal texts the row of least doc_id stays, null ids after all others; of rows that also share the id, the first by
locator. Every row is returned, repeated ones too, with one kept in each group. An empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from .columns import pick, pick_as

#: Keyed state on disk, its memory bounded for all partitions of an executor together; no space set aside for files that
#: stay small, of which each partition has several.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Bytes of log that a micro-batch takes.
BATCH_BYTES = 1 << 30
#: A digest is hot if it holds this part of all rows or more; there are no more of them than its inverse.
HOT_PART = 1000


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def normalised(text: Column) -> Column:
    """Each run of white space as one space. Only runs that are not one space already are matched."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*", " ")


def located(documents: DataFrame) -> DataFrame:
    """doc_id, text, file, row of documents that are read from Parquet files."""
    at = documents.metadataColumn("_metadata")
    whole = documents.select("*", at["file_path"].alias("__content_file"), at["row_index"].alias("__content_row"))
    return pick_as(whole, {"doc_id": "doc_id", "text": "text", "file": "__content_file", "row": "__content_row"})


def _row() -> Column:
    """Rows in the order in which they are kept."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")


class DigestState:
    """A folder with the log and the stream's checkpoint; it may be opened again by a later application."""

    def __init__(self, spark: SparkSession, folder: str, batch_bytes: int = BATCH_BYTES):
        self.spark, self.folder, self.batch_bytes = spark, folder, batch_bytes

    def add(self, rows: DataFrame, batch: str, digest: Callable[[Column], Column] = lambda sha: sha) -> None:
        """Takes in rows (doc_id, text, file, row) under a batch's name, of letters and digits. A batch whose log is
        complete is not written again, so the call may be repeated after a failure."""
        path = f"{self.folder}/log/batch={batch}"
        if not self._is_there(f"{path}/_SUCCESS"):
            sha = F.unhex(F.sha2(normalised(F.col("text")), 256))
            log = rows.select("doc_id", "file", "row", sha.alias("sha")).withColumn("digest", digest(F.col("sha")))
            log.write.mode("overwrite").option("compression", "zstd").parquet(path)
        schema = self.spark.read.parquet(path).schema
        stream = self.spark.readStream.schema(schema).option("maxBytesPerTrigger", self.batch_bytes).parquet(f"{self.folder}/log")
        kept = stream.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(_row()).alias("keep"))
        with _settings(self.spark, STATE):
            query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()

    def log(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/log").select("doc_id", "file", "row", "sha", "digest")

    def state(self) -> DataFrame:
        """digest, group_size, keep (no_id, doc_id, file, row), as the stream left them."""
        with _settings(self.spark, STATE):
            return self.spark.read.format("statestore").load(f"{self.folder}/state").select("key.digest", F.col("value.count").alias("group_size"), F.col("value.min").alias("keep"))

    def remove(self) -> None:
        fs, path = self._at(self.folder)
        fs.delete(path, True)

    def _is_there(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p


def _is_kept() -> Column:
    return (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))


def decided(scratch: Scratch, index: DigestState, content: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """file, row, doc_id, sha, group_size, keep for every row of the log, and the tables that these read; content holds
    the rows' texts (doc_id, text, file, row)."""
    log = index.log()
    total = log.count()
    if not total:
        none = scratch.table(log.withColumn("group_size", F.lit(0).cast("long")).withColumn("keep", _row()), "none")
        return none, [none]
    state = scratch.table(index.state(), "state")
    # group_size sums to total over all digests, so at most HOT_PART of them reach the bound.
    hot = scratch.table(state.filter(F.col("group_size") * HOT_PART >= total), "hot")
    cold = log.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(state, "digest")
    rows = scratch.table(cold.unionByName(log.join(F.broadcast(hot), "digest")), "rows")

    hits = rows.filter("group_size > 1").select("file", "row", "digest", _is_kept().cast("int").alias("keeper"))
    fetched = content.join(hits, ["file", "row"]).withColumn("text", normalised(F.col("text")))
    texts = fetched.groupBy("digest", "text").agg(F.max("keeper").alias("keeper"))
    # Digests that also stand for another text than the kept row's.
    other = scratch.table(texts.filter("keeper = 0").select("digest").distinct(), "other")
    if other.isEmpty():
        return rows, [rows]
    mixed = scratch.table(fetched.join(other, "digest", "left_semi"), "mixed")
    by_text = mixed.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.min(_row()).alias("keep"))
    exact = mixed.select("file", "row", "digest", "text").join(by_text, ["digest", "text"]).select("file", "row", "group_size", "keep")
    apart = rows.join(other, "digest", "left_semi").drop("group_size", "keep").join(exact, ["file", "row"])
    return rows.join(other, "digest", "left_anti").unionByName(apart), [rows, other, mixed]


def exact_dedup(documents: DataFrame, in_place: bool = False, digest: Callable[[Column], Column] = lambda sha: sha, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row. in_place: documents is read from Parquet files as
    it is, and its rows are located there; otherwise its ids and texts are written to the shared folder first. digest
    is made from the text's SHA-256; a shorter one costs time, never rightness."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    content = located(documents if in_place else scratch.table(pick(documents, "doc_id", "text"), "content"))
    index = DigestState(spark, f"{scratch.root}/index", batch_bytes)
    index.add(content, "all", digest)
    rows, tables = decided(scratch, index, content)
    scratch.keep_only(*tables)
    index.remove()
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", _is_kept().alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first_copies(documents: DataFrame) -> DataFrame:
    """documents, all columns, one row of each group of equal texts."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    held = scratch.table(documents.toDF(*[f"c{i}" for i in range(len(documents.columns))]), "content")
    lower = [c.lower() for c in documents.columns]
    at = held.metadataColumn("_metadata")
    whole = held.select("*", at["file_path"].alias("file"), at["row_index"].alias("row"))
    content = pick_as(whole, {n: f"c{documents.columns.index(n) if n in documents.columns else lower.index(n)}" for n in ("doc_id", "text")} | {"file": "file", "row": "row"})
    index = DigestState(spark, f"{scratch.root}/index")
    index.add(content, "all")
    rows, tables = decided(scratch, index, content)
    scratch.keep_only(held, *tables)
    index.remove()
    return whole.join(rows.filter(_is_kept()).select("file", "row"), ["file", "row"], "left_semi").drop("file", "row").toDF(*documents.columns)


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), in_place=True)


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""

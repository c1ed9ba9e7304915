"""Sharding by extendible hashing.

Every row has a hash; a directory indexed by hash-prefix bits maps it to a bucket. A bucket that holds more than
the byte limit is split on one more bit, and only such a bucket, until each fits. The directory is made from byte
sums per prefix, sixteen bits at a time: only prefixes still too large after sixteen bits are summed again on
thirty-two, and so on, so the sums stay small however much text there is. Rows meet the directory in an ordinary
equi-join; Spark broadcasts it only below its own size threshold.

Defined cases: null text has no bytes and still gets a shard. A null doc_id hashes as the empty string. Rows alike in
doc_id and text have one hash and stay together. A bucket of one single hash cannot be split; it is kept whole and
marked oversized (one document above the limit, or copies of one row). An empty table gives no rows. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import pick
from ..scratch import Scratch

BITS, LEVEL = 60, 16


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of md5, which other engines have as well."""
    key = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(text))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def _leaves(sums: DataFrame, low: int, depth: int, limit: int) -> DataFrame:
    """sums: prefix, bytes, least, most of hashes at depth. Buckets between depths low and depth whose parent had to split."""
    at = sums.select(F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("d"), "prefix", "bytes", "least", "most")
    by = at.groupBy("d", F.expr(f"shiftright(prefix, {depth} - d)").alias("p")).agg(F.sum("bytes").alias("bytes"), F.min("least").alias("least"), F.max("most").alias("most"))
    fits = by.withColumn("fits", (F.col("bytes") <= limit) | (F.col("least") == F.col("most")) | (F.col("d") == BITS))
    # For each finest prefix, the directory's entry: its shallowest bucket that fits, null if none does yet.
    entry = F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("d")
    keys = sums.select(F.col("prefix").alias("entry"), entry).withColumn("p", F.expr(f"shiftright(entry, {depth} - d)"))
    least = F.min(F.when(F.col("fits"), F.struct("d", "p", "bytes"))).alias("leaf")
    return keys.join(fits, ["d", "p"]).groupBy("entry").agg(least)


def assign_shards(documents: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, shard (the bucket's hash-prefix bits, empty if there is one bucket only), depth, shard_bytes, oversized."""
    # Hashes are worked out once; every level reads the rows that are left, a few bytes each.
    scratch = Scratch(documents.sparkSession, "sharding")
    rows = pick(documents, "doc_id", "text").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), row_hash(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("h"))
    done, rest, low = None, scratch.table(rows, "hashes"), 0
    for depth in range(LEVEL, BITS + LEVEL, LEVEL):
        depth = min(depth, BITS)
        keyed = rest.withColumn("entry", _prefix(F.col("h"), depth))
        sums = keyed.groupBy(F.col("entry").alias("prefix")).agg(F.sum("n_bytes").alias("bytes"), F.min("h").alias("least"), F.max("h").alias("most"))
        entries = scratch.table(_leaves(sums, low, depth, limit), "entries")
        found = keyed.join(entries, "entry", "left")
        settled = found.filter("leaf is not null").select("doc_id", "n_bytes", "leaf.d", "leaf.p", "leaf.bytes")
        done = settled if done is None else done.unionByName(settled)
        if depth == BITS or entries.filter("leaf is null").isEmpty():
            break
        rest, low = scratch.table(found.filter("leaf is null").select("doc_id", "n_bytes", "h"), "rest"), depth + 1
    bits = F.when(F.col("d") == 0, "").otherwise(F.lpad(F.bin("p"), F.col("d"), F.lit("0")))
    return done.select("doc_id", "n_bytes", bits.alias("shard"), F.col("d").cast("int").alias("depth"), F.col("bytes").alias("shard_bytes"), (F.col("bytes") > limit).alias("oversized"))


def write_shards(documents: DataFrame, limit: int, path: str) -> str:
    """Parquet files, a folder for each shard, named p and the bits of its hash prefix (p alone if there is one shard),
    by a column whose name is returned: shard, or with underscores before it where documents has such a column. Rows are
    dealt by shard, whose bytes are bounded."""
    plain = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    lower = [c.lower() for c in documents.columns]
    name = "shard"
    while name in lower:
        name = "_" + name
    doc_id, text = (F.col(f"c{lower.index(c)}") for c in ("doc_id", "text"))
    keyed = plain.withColumn("h", row_hash(doc_id, F.coalesce(text, F.lit(""))))
    shards = Scratch(documents.sparkSession, "sharding").table(assign_shards(documents, limit).select("shard", "depth").distinct(), "shards")
    out = None
    for d in sorted(r["depth"] for r in shards.select("depth").distinct().collect()):  # 61 at most
        p = F.lpad(F.bin(_prefix(F.col("h"), d)), d, "0") if d else F.lit("")
        part = keyed.withColumn("p", p).join(shards.filter(F.col("depth") == d).select(F.col("shard").alias("p")), "p", "left_semi")
        out = part if out is None else out.unionByName(part)
    if out is not None:
        named = out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)], F.concat(F.lit("p"), "p").alias(name))
        named.repartition(name).write.partitionBy(name).parquet(path)
    return name


#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20


def op5_extendible_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), SHARD_BYTES)


OP5_SQL = f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), depths AS (SELECT d::INT AS d FROM range(0, {BITS + 1}) t(d)),
b AS (SELECT d, h >> (60 - d) AS p, sum(n_bytes) AS bytes, min(h) = max(h) AS one FROM r, depths GROUP BY 1, 2),
leaf AS (
  SELECT r.doc_id, r.n_bytes, b.d, b.p, b.bytes, row_number() OVER (PARTITION BY r.doc_id, r.h ORDER BY b.d) AS k
  FROM r JOIN depths ON true JOIN b ON b.d = depths.d AND b.p = r.h >> (60 - depths.d)
  WHERE b.bytes <= {SHARD_BYTES} OR b.one
)
SELECT doc_id, n_bytes, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d, '0') END AS shard, d AS depth,
       bytes::BIGINT AS shard_bytes, bytes > {SHARD_BYTES} AS oversized
FROM leaf WHERE k = 1
"""

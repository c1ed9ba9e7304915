"""Quality rules with a hashed n-gram log-likelihood ratio, in Spark expressions only.

Base rules count words, symbols, repeated lines and words inside repeated eight-word windows. The verdict of the rest
compares two multinomials over hashed word n-grams: the trusted target (documents labelled good) and the raw corpus
(all documents). A document's score is the mean of log p_target - log p_raw over its n-grams, and it is kept if that
mean reaches a fixed threshold. Counts have one row for each bucket, summed in each task before they are shuffled,
so the model's size is fixed by n_buckets.

Defined cases: null text has no words; it fails the base rules. A document with too few words for any n-gram scores
0. Without trusted documents every score is 0. Copies of a row score alike and are all returned. A doc_id may stand
in several rows: rows are told apart by doc_id and text. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import pick
from ..scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8
N_BUCKETS = 1 << 16
ORDERS = (1, 2)
#: Kept from this mean log-likelihood ratio on: raw text in general lies near 0, junk well below.
THRESHOLD = -0.2
SMOOTHING = 1.0


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once: a lambda binds it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _paired(h: Column, step: int) -> Column:
    """Hashes of h[i] with h[i + step]. Inside a lambda Spark interprets: two cuts of the array are cheaper than one for each place."""
    n = F.greatest(F.size(h) - step, F.lit(0))
    return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))


def _repeat_words(words: Column) -> Column:
    """Words within windows that occur twice or more. Windows are hashed by doubling (1, 2, 4, 8 words) and sorted, so equal ones are neighbours."""
    n = F.size(words) - (WINDOW - 1)
    hashes = _let(F.transform(words, lambda w: F.xxhash64(w)), lambda one: _let(_paired(one, 1), lambda two: _let(_paired(two, 2), lambda four: _paired(four, 4))))

    def covered(h: Column) -> Column:
        tagged = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(s, 1, F.size(s) - 1))
            after = F.concat(F.slice(s, 2, F.size(s) - 1), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
            same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
            left = F.zip_with(s, before, lambda a, b: F.struct(a["i"].alias("i"), same(a, b).alias("y"), a["h"].alias("h")))
            both = F.zip_with(left, after, lambda a, b: F.when(a["y"] | same(a, b), a["i"]))
            at = F.array_sort(F.filter(both, lambda x: x.isNotNull()))
            # Each window adds eight words, less what the next one covers again.
            gaps = lambda p: F.aggregate(
                p,
                F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-WINDOW).alias("last")),
                lambda acc, x: F.struct((acc["sum"] + F.least(x - acc["last"], F.lit(WINDOW))).alias("sum"), x.alias("last")),
                lambda acc: acc["sum"],
            )
            return gaps(at)

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_let(tagged, marked))

    return F.when(n >= 2, _let(hashes, covered)).otherwise(F.lit(0).cast("long"))


def base_columns(documents: DataFrame) -> DataFrame:
    """doc_id, th, and the base counts of every row."""
    docs = pick(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    words = _let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("c"), _repeat_words(w).alias("r")))
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("th"),
        words.alias("w"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
    ).select("doc_id", "th", F.col("w.n").alias("n_words"), F.col("w.c").alias("word_chars"), "n_symbols", "n_dup_lines", F.col("w.r").alias("n_repeat_words"))


def _exploded(docs: DataFrame, keys: list[str], n_buckets: int, orders) -> DataFrame:
    """The keys and a bucket for every n-gram. A word is exploded together with those after it, so hashes are made in
    compiled code; an n-gram is an (n-1)-gram and the word after it."""
    words = docs.select(*keys, F.split(F.btrim("text", F.lit(" \t\n\x0b\x0c\r")), SPACE, -1).alias("ws"))
    shifted = [F.col("ws"), *[F.slice("ws", F.lit(i), F.size("ws")) for i in range(2, max(orders) + 1)]]
    names = [f"g{i}" for i in range(1, max(orders) + 1)]
    rows = words.select(*keys, F.inline(F.arrays_zip(*[x.alias(n) for x, n in zip(shifted, names)])).alias(*names)).filter("g1 <> ''")
    made, last = [], None
    for i, n in enumerate(names, 1):
        last = F.xxhash64(n) if last is None else F.xxhash64(last, F.xxhash64(n))
        if i in orders:
            made.append(F.when(F.col(n).isNotNull(), F.pmod(last, F.lit(n_buckets)).cast("int")))
    return rows.select(*keys, F.explode(F.array(*made)).alias("bucket")).filter("bucket is not null")


def ratio_table(documents: DataFrame, trusted_ids: DataFrame, n_buckets: int = N_BUCKETS, orders=ORDERS, smoothing: float = SMOOTHING) -> DataFrame:
    """bucket, weight: log p_target - log p_raw for each bucket that occurs, with additive smoothing. One pass over the
    texts counts both. Every trusted id counts: texts are shuffled once to the ids' partitions, where only the ids are
    held; nothing is sorted or broadcast, so the plan is the same at any size. Rows without an id are not shuffled."""
    docs = pick(documents, "doc_id", "text").filter("text is not null")
    ids = trusted_ids.select("doc_id").filter("doc_id is not null").distinct().withColumn("trusted", F.lit(1))
    flagged = docs.filter("doc_id is not null").join(ids.hint("shuffle_hash"), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(0)).alias("trusted"))
    flagged = flagged.unionByName(docs.filter("doc_id is null").select("text", F.lit(0).alias("trusted")))
    counts = _exploded(flagged, ["trusted"], n_buckets, orders).groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    both = Scratch(documents.sparkSession, "quality-rules").table(counts, "counts")
    total = both.agg(F.sum("raw").alias("raw_all"), F.sum("target").alias("target_all"))  # one row
    a, v = smoothing, n_buckets
    weight = F.log((F.col("target") + a) / (F.col("target_all") + a * v)) - F.log((F.col("raw") + a) / (F.col("raw_all") + a * v))
    return both.join(F.broadcast(total)).select("bucket", F.when(F.col("target_all") > 0, weight).otherwise(0.0).alias("weight"))


def apply_rules(documents: DataFrame, trusted_ids: DataFrame, n_buckets: int = N_BUCKETS, orders=ORDERS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, llr, kept."""
    table = ratio_table(documents, trusted_ids, n_buckets, orders)
    docs = pick(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    grams = _exploded(docs, ["doc_id", "th"], n_buckets, orders)
    # The table has n_buckets rows at most, which bounds what is broadcast. Weights are summed as integers (2^-32), so
    # the order of addition changes nothing.
    fixed = table.select("bucket", F.round(F.col("weight") * 4294967296.0).cast("long").alias("w"))
    score = grams.join(F.broadcast(fixed), "bucket").groupBy("doc_id", "th").agg((F.sum("w") / F.count("*") / 4294967296.0).alias("llr"))
    base = base_columns(documents)
    same = base["doc_id"].eqNullSafe(score["doc_id"]) & (base["th"] == score["th"])
    joined = base.join(score, same, "left").select(base["*"], F.coalesce(score["llr"], F.lit(0.0)).alias("llr"))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr")


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return apply_rules(documents, trusted)

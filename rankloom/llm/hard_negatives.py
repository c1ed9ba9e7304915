"""Hard negatives by distributed radix selection on whole-number scores.

Every anchor meets every row, in blocks: a task multiplies a block of anchors by a slice of row blocks. First each
anchor's positives are selected, the best rows of its label; then, for each anchor and positive, the best rows of other
labels whose score lies in the window that the positive's score sets. A selection never sorts scores: tasks count
them in histograms over the leading bits of a window, the sums tell the bucket that holds the k-th score, and that
bucket is divided by the next bits, until it holds few scores or a single one. Only rows from there on are gathered
and ranked. A task ends its histogram where its own count reaches k (the k-th of all cannot lie lower) and of the rows
to gather sends its own k best, so equal scores, however many, add nothing.

Scores and counts are exact. Nothing is held for all rows: a task holds one block of anchors, their histograms and
one block of rows.

Defined cases: rows without a label or a finite vector take no part, neither as anchors nor otherwise. A row with a
null id is no anchor if the condition on ids says so; among equal scores it comes after all ids. Shorter vectors are
filled up with 0. A row is never its own positive, its copies are; repeated anchors give repeated rows. Of equal
scores and ids (copies) any is taken, as they look alike. An anchor without positives, or a window without rows, gives
no rows; a positive of negative score has an empty window. A score beyond 64 bits is an error. An empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..scratch import Scratch
from ..shipping import map_arrow, ship
from . import vectors

#: Anchors of a block; rows of a slice; leading bits of a window that one histogram counts by.
ANCHORS, SLICE_ROWS, BITS = 512, 1 << 16, 10
#: A bucket of so many scores is gathered, not divided.
FEW = 32

_ANCHOR = "vec_id long, no_id boolean, label long, own_block long, own_row int, x binary, width int"


def _anchors_of(divisor: int | None):
    """Rows of blocks that are anchors, one row each."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, no_id, labels = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["no_id"], bool), np.frombuffer(r["labels"], "<i8")
                m = vectors.matrix(r)
                at = np.arange(r["n"]) if divisor is None else np.flatnonzero((ids % divisor == 0) & ~no_id)
                yield pa.RecordBatch.from_pylist(
                    [{"vec_id": int(ids[i]), "no_id": bool(no_id[i]), "label": int(labels[i]), "own_block": r["block"], "own_row": int(i), "x": m[i].tobytes(), "width": r["width"]} for i in at],
                    schema=pa.schema([("vec_id", pa.int64()), ("no_id", pa.bool_()), ("label", pa.int64()), ("own_block", pa.int64()), ("own_row", pa.int32()), ("x", pa.binary()), ("width", pa.int32())]),
                )

    return run


class _Side:
    """A block of anchors with its open windows, as a task holds it."""

    def __init__(self, table: pa.Table):
        r = table.slice(0, 1).to_pylist()[0]
        rows = r["anchors"]
        self.block = r["ab"]
        self.labels = np.array([x["label"] for x in rows], np.int64)
        self.own_block = np.array([x["own_block"] for x in rows], np.int64)
        self.own_row = np.array([x["own_row"] for x in rows], np.int64)
        self.m = np.stack([np.frombuffer(x["x"], f"<i{x['width']}").astype(np.int64) for x in rows])
        self.windows = sorted((x["a"], x["w"], x["lo"], x["hi"], x["need"]) for x in r["windows"])
        self.a, self.w, self.lo, self.hi, self.need = (np.array(c, np.int64) for c in zip(*self.windows))

    def candidates(self, row: dict, same_label: bool):
        """(window, place in the block, score) arrays of the block's rows that lie in windows, a chunk at a time."""
        labels, m = np.frombuffer(row["labels"], "<i8"), vectors.matrix(row)
        first = np.searchsorted(self.a, np.arange(len(self.labels) + 1))
        has = np.flatnonzero(first[1:] > first[:-1])
        for label in np.unique(self.labels[has]):
            chosen = np.flatnonzero(labels == label) if same_label else np.flatnonzero(labels != label)
            anchors = has[self.labels[has] == label]
            if not len(chosen) or not len(anchors):
                continue
            scores = vectors.exact_product(self.m[anchors], m[chosen])
            for a, own in zip(anchors, scores):
                windows = slice(first[a], first[a + 1])
                near = np.flatnonzero((own >= self.lo[windows].min()) & (own <= self.hi[windows].max()))
                if same_label and self.own_block[a] == row["block"]:
                    near = near[chosen[near] != self.own_row[a]]
                for w in range(windows.start, windows.stop):
                    inside = near[(own[near] >= self.lo[w]) & (own[near] <= self.hi[w])]
                    if len(inside):
                        yield w, chosen[inside], own[inside]


def _shifts(lo: np.ndarray, hi: np.ndarray, bits: int) -> np.ndarray:
    return np.array([max(int(h - l).bit_length() - bits, 0) for l, h in zip(lo, hi)], np.int64)


def _histograms(same_label: bool, bits: int):
    """ab, a, w, bucket, n: counts by leading bits of (hi - score), each window's from the top until they reach need."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            side = _Side(right)
            shift = _shifts(side.lo, side.hi, bits)
            counts = np.zeros((len(side.a), 1 << bits), np.int64)
            for batch in left.to_batches(max_chunksize=1):
                for w, _, scores in side.candidates(batch.to_pylist()[0], same_label):
                    buckets, n = np.unique((side.hi[w] - scores) >> shift[w], return_counts=True)
                    counts[w, buckets] += n
            before = np.cumsum(counts, axis=1) - counts
            ws, buckets = np.nonzero((counts > 0) & (before < side.need[:, None]))
            out = [np.full(len(ws), side.block), side.a[ws], side.w[ws], buckets, counts[ws, buckets]]
        return pa.table([pa.array(c, pa.int64()) for c in out or [[]] * 5], names=["ab", "a", "w", "bucket", "n"])

    return run


def _gathered(same_label: bool, k: int):
    """ab, a, w, vec_id, no_id, score of the slice's k best rows of each window."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            side = _Side(right)
            for batch in left.to_batches(max_chunksize=1):
                row = batch.to_pylist()[0]
                ids, no_id = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["no_id"], bool)
                for w, at, scores in side.candidates(row, same_label):
                    best = np.lexsort((ids[at], no_id[at], -scores))[:k]
                    found.append((np.full(len(best), w), ids[at][best], no_id[at][best], scores[best]))
        if not found:
            empty = [pa.array([], t) for t in (*[pa.int64()] * 4, pa.bool_(), pa.int64())]
            return pa.table(empty, names=["ab", "a", "w", "vec_id", "no_id", "score"])
        ws, ids, no_id, scores = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids, no_id, -scores, ws))
        sorted_ws = ws[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_ws, sorted_ws)
        order = order[place < k]
        columns = [np.full(len(order), side.block), side.a[ws[order]], side.w[ws[order]], ids[order], no_id[order], scores[order]]
        return pa.table([pa.array(c) for c in columns], names=["ab", "a", "w", "vec_id", "no_id", "score"])

    return run


class _Grid:
    """Blocks of anchors against slices of row blocks."""

    def __init__(self, scratch: Scratch, rows: DataFrame, divisor: int | None, block_anchors: int, bits: int, few: int):
        self.scratch, self.bits, self.few = scratch, bits, few
        spark = rows.sparkSession
        anchors = scratch.table(map_arrow(rows, _anchors_of(divisor), _ANCHOR), "anchor-rows")
        self.n_anchors = anchors.count()
        total, norm2 = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("norm2"), F.lit(0.0))).first()
        self.bound = norm2 * (1 + 1e-9) + 1  # no score lies beyond (Cauchy-Schwarz)
        if not self.n_anchors:
            return
        if self.bound >= 2.0**61:
            raise OverflowError("an inner product may be too large for a whole number of 64 bits")
        parts = -(-4 * self.n_anchors // (3 * block_anchors))
        within = W.partitionBy("part").orderBy("own_block", "own_row")
        numbered = anchors.withColumn("part", F.pmod(F.xxhash64("own_block", "own_row"), F.lit(parts))).withColumn("i", F.row_number().over(within) - 1)
        # Parts are a little under a block; what a part has beyond one makes another block.
        numbered = numbered.withColumn("ab", F.col("part") + F.floor(F.col("i") / block_anchors) * parts)
        packed = numbered.groupBy("ab").agg(F.array_sort(F.collect_list(F.struct("i", "vec_id", "label", "own_block", "own_row", "x", "width"))).alias("anchors"))
        self.anchors = scratch.table(packed, "anchors")
        n_blocks = self.anchors.agg(F.max("ab") + 1).first()[0]
        # Slices bound what a task holds; there are enough of them to keep the cores busy with few blocks of anchors.
        self.n_slices = max(-(-total // SLICE_ROWS), -(-2 * spark.sparkContext.defaultParallelism // n_blocks))
        self.left = rows.select(
            *("block", "n", "dims", "width", "ids", "no_id", "labels", "matrix"),
            F.pmod(F.xxhash64("block"), F.lit(self.n_slices)).alias("s"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("ab"),
        )

    def first_windows(self, k: int) -> DataFrame:
        """One window for each anchor, over all scores that there may be."""
        top = int(self.bound)
        each = self.anchors.select("ab", F.posexplode("anchors").alias("a", "r"))
        return each.select("ab", F.col("a").cast("long").alias("a"), F.lit(0).cast("long").alias("w"), F.lit(-top).cast("long").alias("lo"), F.lit(top).cast("long").alias("hi"), F.lit(k).cast("long").alias("need"))

    def _run(self, windows: DataFrame, function, schema: str) -> DataFrame:
        # A block has so many anchors and a few windows for each, which bounds the list.
        own = windows.groupBy("ab").agg(F.collect_list(F.struct("a", "w", "lo", "hi", "need")).alias("windows"))
        right = self.anchors.join(own, "ab").withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.n_slices - 1).cast("long"))))
        return self.left.groupBy("ab", "s").cogroup(right.groupBy("ab", "s")).applyInArrow(function, schema)

    def select(self, windows: DataFrame, same_label: bool, k: int) -> DataFrame:
        """ab, a, w, rank, vec_id, no_id, score: the k best rows of each window (all, if fewer)."""
        windows = self.scratch.table(windows.withColumn("top", F.col("hi")), "windows")
        done = None
        while True:
            counts = self._run(windows, _histograms(same_label, self.bits), "ab long, a long, w long, bucket long, n long")
            counts = counts.groupBy("ab", "a", "w", "bucket").agg(F.sum("n").alias("n"))
            upto = counts.withColumn("upto", F.sum("n").over(W.partitionBy("ab", "a", "w").orderBy("bucket")))
            met = upto.join(windows, ["ab", "a", "w"]).filter("upto >= need and upto - n < need").select("ab", "a", "w", "bucket", "n", "upto")
            bits = F.greatest(F.length(F.bin(F.col("hi") - F.col("lo"))) - self.bits, F.lit(0))
            found = windows.join(met, ["ab", "a", "w"], "left").withColumn("shift", bits)
            # Without such a bucket all that lies in the window is wanted.
            lo = F.expr("CASE WHEN bucket IS NULL THEN lo ELSE greatest(lo, hi - shiftleft(bucket + 1, shift) + 1) END")
            hi = F.expr("CASE WHEN bucket IS NULL THEN hi ELSE hi - shiftleft(bucket, shift) END")
            need = F.expr("CASE WHEN bucket IS NULL THEN need ELSE need - (upto - n) END")
            ends = F.coalesce((F.col("n") <= self.few) | (F.col("shift") == 0), F.lit(True))
            after = self.scratch.table(found.select("ab", "a", "w", lo.alias("lo"), hi.alias("hi"), need.alias("need"), "top", ends.alias("ends")), "narrowed")
            part = after.filter("ends").select("ab", "a", "w", "lo", F.col("top").alias("hi"), "need")
            done = part if done is None else done.unionByName(part)
            windows = after.filter("not ends").drop("ends")
            if windows.isEmpty():
                break
        rows = self._run(done, _gathered(same_label, k), "ab long, a long, w long, vec_id long, no_id boolean, score long")
        best = W.partitionBy("ab", "a", "w").orderBy(F.desc("score"), "no_id", "vec_id")
        return self.scratch.table(rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "best")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchors_divide: int | None = None, scale: int = 256, n_positives: int = 5, n_negatives: int = 5, least_percent: int = 80, block_anchors: int = ANCHORS, bits: int = BITS, few: int = FEW) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: vec_id, label (a whole number),
    embedding. Anchors are the rows whose id anchors_divide divides (all, if None). A window holds the scores from
    least_percent of the positive's score up to it. block_anchors, bits and few set the work of a task only."""
    spark = rows.sparkSession
    ship(spark)
    scratch = Scratch(spark, "hard-negatives")
    packed, _ = vectors.blocks(scratch, rows, scale, needs_label=True)
    grid = _Grid(scratch, packed, anchors_divide, block_anchors, bits, few)
    if not grid.n_anchors:
        scratch.drop_all()
        return spark.createDataFrame([], RESULT)
    nearest = grid.select(grid.first_windows(n_positives), True, n_positives)
    positives = nearest.withColumn("w", F.col("rank").cast("long"))
    floor = F.expr(f"{least_percent} * (score div 100) + ({least_percent} * (score % 100) + 99) div 100")  # rounded up, without overflow
    windows = positives.select("ab", "a", "w", floor.alias("lo"), F.col("score").alias("hi"), F.lit(n_negatives).cast("long").alias("need")).filter("hi >= 0 and lo <= hi")
    negatives = grid.select(windows, False, n_negatives)
    ids = grid.anchors.select("ab", F.posexplode("anchors").alias("a", "r")).select("ab", F.col("a").cast("long").alias("a"), F.col("r.vec_id").alias("anchor_id"))
    named = lambda c: F.when(~F.col("no_id"), F.col("vec_id")).alias(c)
    pairs = positives.select("ab", "a", "w", named("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.select("ab", "a", "w", "rank", named("negative_id"), F.col("score").alias("negative_score"))
    scratch.keep_only(grid.anchors, nearest, negatives)
    return out.join(pairs, ["ab", "a", "w"]).join(ids, ["ab", "a"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


#: Ids that these divide: anchors, and rows whose label is moved on by one of ten.
ANCHORS_DIVIDE, MOVED_DIVIDE, N_LABELS = 100, 7, 10


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % MOVED_DIVIDE == 0, (F.col("label") + 1) % N_LABELS).otherwise(F.col("label"))
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, ANCHORS_DIVIDE)


OP12_SQL = f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % {MOVED_DIVIDE} = 0 THEN (label + 1) % {N_LABELS} ELSE label END AS label,
         [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.rid, r.vec_id, r.label = a.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % {ANCHORS_DIVIDE} = 0 AND r.rid <> a.rid
), p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

"""Similarity join of documents on word shingles, by vertical partitioning.

A document is the set of its distinct five-word shingles; two link when 100 |A and B| >= 80 |A or B|.

1. Equal sets fall together in classes (same key: a hash and the size); links are sought between classes only.
2. The global order of shingles goes from rare to common, by counts of 65536 hash buckets over all documents, then by
   hash. Linked sets must share a shingle among the first |A| - ceil(0.8 |A|) + 1 of each, so only these are
   exchanged, with their places; shingles that one class alone has, or that stand early in no set, are dropped, and of
   lists with the same classes the first in the order stays. What two sets share lies from their first shared shingle
   on, so its places bound the overlap, and pairs for which the bound is too low are left out in every list.
3. In rounds, each list has a leader, every class takes the leader of other component that is likest by sketch, and
   the links found join components; a list whose classes are all in one component is done, as a pair inside one
   component can change nothing. Rounds go on, each with other leaders, as long as they make links in some number.
4. Lists that still hold several components are compared in full, block by block, across components only. Of the
   pairs found each class's likest comes first; what then still lies between components is counted too.
5. Pairs are cleared by sizes and by parity sketches (the bits in which two sketches differ never exceed the shingles
   in which the sets differ, so nothing that links is lost), and those left are counted exactly: the global order is
   cut at pivots into fragments of equal weight, each set with it, overlaps are counted fragment by fragment and
   summed per pair.
6. Components come from alternating stars over the links.

So the pairs that are made grow with the classes in a group, and with those pairs of different components that lie
just below the threshold, not with the square of the group.

Defined cases: null and empty texts have an empty set and link with nothing. Texts of one to four words have one
shingle, the whole sequence. Repeated rows are copies: each is returned, in one component. A null doc_id takes part
but never names a component unless all of it are null. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytes_ops
from .columns import pick
from ..operators.components import components
from ..scratch import Scratch
from ..shipping import map_arrow

WORDS, PERCENT = 5, 80
BUCKETS = 1 << 16
SKETCH = 1024
#: Sets above so many shingles have a second sketch of so many bits, as the first says nothing of large sets.
LARGE, WIDE = 500, 8192
FRAGMENTS = 8
#: Leaders of a list: one for so many classes, at most so many. A round is followed by another if it made a link for
#: every so many rows of open lists.
PER_LEADER, LEADERS, PRODUCTIVE = 32, 8, 100
#: A list's members are compared in blocks of about so many.
BLOCK = 256
#: Rows of 8 bytes that may be broadcast, after a count.
BROADCAST_ROWS = 200_000

#: Stands for a null doc_id.
NO_ID = -(2**63)

_U = np.uint64
_WEIGHTS = bytes_ops.mix(np.arange(1, 64, dtype=np.uint64) * _U(0xD1B54A32D192ED03)) | _U(1)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For every text, its distinct shingles as sorted hashes."""
    for _, data, offsets in bytes_ops.slices(column):
        data = bytes_ops.lowered(data)
        starts, ends, before = bytes_ops.words(data, offsets)
        h = bytes_ops.RangeHash(data)(starts, ends)
        n = len(h) - WORDS + 1
        grams = np.zeros(max(n, 0), np.uint64)
        for j in range(WORDS):
            grams += h[j : j + len(grams)] * _WEIGHTS[j]
        grams = bytes_ops.mix(grams + _U(WORDS))
        for a, b in zip(before[:-1], before[1:]):
            if b - a >= WORDS:
                yield np.unique(grams[a : b - WORDS + 1])
            elif b > a:
                yield bytes_ops.mix((h[a:b] * _WEIGHTS[: b - a]).sum(keepdims=True) + _U(b - a))
            else:
                yield grams[:0]


def _key(s: np.ndarray) -> int:
    return int(bytes_ops.mix(bytes_ops.mix(s + _U(0x5851F42D4C957F2D)).sum(keepdims=True) + _U(len(s))).view(np.int64)[0])


def _parity(s: np.ndarray, bits: int) -> np.ndarray:
    return np.packbits(np.bincount((s & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document (hash of its text, key, size, sketches), and at a task's end its counts of shingle buckets."""
    total = np.zeros(BUCKETS, np.int64)
    names = ["doc", "th", "k", "n", "sketch", "wide", "bucket", "count"]
    for batch in batches:
        ks, ns, sk, wide = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            ks.append(_key(s))
            ns.append(len(s))
            sk.append(_parity(s, SKETCH))
            wide.append(_parity(s, WIDE).tobytes() if len(s) > LARGE else None)
            at, counts = np.unique(s >> _U(48), return_counts=True)  # sorted already
            total[at.astype(np.int64)] += counts
        m = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("th"), pa.array(ks, pa.int64()), pa.array(ns, pa.int64()), _lists(sk), pa.array(wide, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64())], names=names)
    at = np.flatnonzero(total)
    m = len(at)
    yield pa.RecordBatch.from_arrays([*[pa.nulls(m, pa.int64())] * 4, pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.binary()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=names)


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _prefixes(counts):
    """The first shingles of every set in the global order, their places, and whether they stand so early that the set
    can be the smaller one of a linked pair; each class once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = counts.value, set()
        for batch in batches:
            ts, ks, at, early = [np.zeros(0, np.uint64)], [], [], []
            for s in shingle_sets(batch.column("text")):
                if not len(s) or (k := _key(s)) in seen:
                    continue
                seen.add(k)
                n = len(s)
                rank = order[(s >> _U(48)).astype(np.int64)]
                # Sorted by hash already, so a stable sort by count gives (count, hash).
                s = s[np.argsort(rank, kind="stable")[: prefix_length(n)]]
                ts.append(s)
                ks.append(np.full(len(s), k))
                at.append(np.arange(len(s), dtype=np.int32))
                early.append((100 + PERCENT) * (n - at[-1].astype(np.int64)) >= 2 * PERCENT * n)
            if ks:
                columns = [np.concatenate(ts).view(np.int64), np.concatenate(ks).astype(np.int64), np.concatenate(at), np.concatenate(early)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["t", "k", "pos", "early"])

    return run


def pivots(counts: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of every bucket: the global order of buckets, rare to common, cut into parts of equal weight."""
    order = np.argsort(counts, kind="stable")
    upto = np.cumsum(counts[order])
    out = np.empty(len(counts), np.int64)
    out[order] = np.minimum(fragments - 1, (upto - counts[order]) * fragments // max(1, int(upto[-1])))
    return out


def _fragments(counts):
    """k, fragment of the global order, the set's shingles in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_bucket = pivots(counts.value, FRAGMENTS)
        for batch in batches:
            ks, fs, sets = [], [], []
            for k, s in zip(batch.column("k").to_pylist(), shingle_sets(batch.column("text"))):
                if not len(s) or _key(s) != k:
                    continue
                f = of_bucket[(s >> _U(48)).astype(np.int64)]
                for i in np.unique(f).tolist():
                    ks.append(k)
                    fs.append(i)
                    sets.append(s[f == i].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int64()), pa.array(fs, pa.int32()), _lists(sets)], names=["k", "f", "s"])

    return run


class _Members:
    """A block of a list's classes as arrays."""

    def __init__(self, x: pa.StructArray):
        self.k, self.c = (x.field(f).to_numpy() for f in ("k", "c"))
        self.n = x.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
        self.rest = self.n - x.field("pos").to_numpy(zero_copy_only=False)
        self.sketch = x.field("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH // 64)  # bits of signed numbers would be counted of their absolute values


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs between two blocks of one list that sizes, places and sketches allow, across components; of the two orders
    of a pair outside the main component one."""
    for batch in batches:
        found = [np.zeros((0, 3), np.int64)]
        for main, queries, members in zip(batch.column("main").to_pylist(), batch.column("q"), batch.column("m")):
            q, m = _Members(queries.values), _Members(members.values)
            small, large = np.minimum(q.n[:, None], m.n[None, :]), np.maximum(q.n[:, None], m.n[None, :])
            ok = (q.c[:, None] != m.c[None, :]) & (100 * small >= PERCENT * large)
            ok &= (100 + PERCENT) * np.minimum(q.rest[:, None], m.rest[None, :]) >= PERCENT * (small + large)
            ok &= (q.k[:, None] < m.k[None, :]) | (m.c == main)[None, :]
            a, b = np.nonzero(ok)
            # |A xor B| <= (100 - p) / (100 + p) (|A| + |B|) for linked sets.
            differ = np.bitwise_count(q.sketch[a] ^ m.sketch[b]).sum(1).astype(np.int64)
            keep = (100 + PERCENT) * differ <= (100 - PERCENT) * (q.n[a] + m.n[b])
            found.append(np.stack([q.k[a[keep]], m.k[b[keep]], differ[keep]], 1))
        every = np.unique(np.concatenate(found), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(every[:, i]) for i in range(3)], names=["a", "b", "d"])


def _wide_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for na, nb, wa, wb in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "wa", "wb"))):
            differ = 0 if wa is None or wb is None else (int.from_bytes(wa, "little") ^ int.from_bytes(wb, "little")).bit_count()
            keep.append((100 + PERCENT) * differ <= (100 - PERCENT) * (na + nb))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _differ(a: str, b: str):
    """Bits in which two sketches differ; plain element access, so it is compiled."""
    return F.expr(" + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SKETCH // 64)))


class _Join:
    def __init__(self, documents: DataFrame):
        self.spark = documents.sparkSession
        self.scratch = Scratch(self.spark, "ngram-join")
        self.docs = pick(documents, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("th"), "text")
        #: Pairs that have been counted, linked or not.
        self.tried: DataFrame | None = None

    def run(self) -> DataFrame:
        sc = self.scratch
        schema = "doc bigint, th bigint, k bigint, n bigint, sketch array<bigint>, wide binary, bucket int, count bigint"
        told = sc.table(map_arrow(self.docs, _describe, schema), "told")
        self.sets = told.filter("k is not null").select("doc", "th", "k", "n", "sketch", "wide")
        filled = self.sets.filter("n > 0")
        # A class is known by one row, the one of least id; rows without an id come last.
        least = F.min(F.struct((F.col("doc") == NO_ID).alias("none"), "doc", "th")).alias("r")
        classes = filled.groupBy("k").agg(least, F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("wide").alias("wide"))
        self.classes = sc.table(classes.select("k", F.col("r.doc").alias("rep"), F.col("r.th").alias("rep_th"), "n", "sketch", "wide"), "classes")
        counts = np.zeros(BUCKETS, np.int64)
        for r in told.filter("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("c")).collect():  # one row for each of 65536 buckets
            counts[r["bucket"]] = r["c"]
        self.order = self.spark.sparkContext.broadcast(counts)
        live, final, turn = self._shared_lists(), None, 0
        while True:
            links = self._linked(self._cleared(self._led(live, turn)))
            final, before = self._merged(final, links), live
            live = self._open(live, final)
            last = links.count() * PRODUCTIVE <= before.count()
            sc.drop(before)
            turn += 1
            if last:
                break
        pairs = self._across(live)
        final = self._merged(final, self._linked(self._cleared(self._likest(pairs))))
        final = self._merged(final, self._linked(self._cleared(self._between(pairs, final))))
        sc.drop(live)
        final = sc.table(final.select(F.col("node").alias("k"), F.col("root").alias("c")), "labels")
        labelled = self.classes.join(final, "k", "left").select("k", "rep", F.coalesce("c", "k").alias("c"))
        least = labelled.groupBy("c").agg(F.min(F.when(F.col("rep") != NO_ID, F.col("rep"))).alias("component_id"))
        of_class = sc.table(labelled.join(least, "c").select("k", "component_id"), "components")
        sc.keep_only(of_class, told)
        own = F.nullif(F.col("doc"), F.lit(NO_ID))
        return self.sets.join(of_class, "k", "left").select(own.alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id"))

    def _shared_lists(self) -> DataFrame:
        """t, k, pos, n, c (component, at first the class), m (classes in the list), sketch: lists of two classes or
        more, of those that hold the same classes the first in the global order, where all of these stand earliest."""
        sc = self.scratch
        prefixes = sc.table(map_arrow(self.docs.select("text"), _prefixes(self.order), "t bigint, k bigint, pos int, early boolean"), "prefixes")
        shared = prefixes.groupBy("t").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.max("early").alias("early")).filter("low <> high and early").select("t")
        shared = sc.table(shared, "shared")
        near = sc.table(prefixes.join(shared, "t").select("t", "k", "pos").distinct(), "near")
        sc.drop(shared, prefixes)
        h = F.xxhash64("k")
        content = [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("x"), F.sum(F.shiftrightunsigned(h, 32)).alias("y"), F.min("k").alias("low"), F.max("k").alias("high")]
        lists = near.groupBy("t").agg(F.count("*").alias("m"), F.min_by("pos", "k").alias("first"), *content)
        lists = lists.groupBy("m", "x", "y", "low", "high").agg(F.min(F.struct("first", "t")).alias("o")).select("o.t", "m")
        live = near.join(lists, "t").join(self.classes.select("k", F.col("n").cast("int").alias("n"), "sketch"), "k").select("t", "k", "pos", "n", F.col("k").alias("c"), "m", "sketch")
        live = sc.table(live, "live")
        sc.drop(near)
        return live

    def _open(self, live: DataFrame, labels: DataFrame) -> DataFrame:
        """Lists that still hold several components."""
        sc = self.scratch
        placed = sc.table(live.drop("c").join(labels.withColumnRenamed("node", "k"), "k", "left").select("t", "k", "pos", "n", F.coalesce("root", "k").alias("c"), "m", "sketch"), "placed")
        several = placed.groupBy("t").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high").select("t")
        out = sc.table(placed.join(several, "t"), "live")
        sc.drop(placed)
        return out

    def _untried(self, pairs: DataFrame) -> DataFrame:
        """a < b, each pair once, without those counted before."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *[c for c in pairs.columns if c not in ("a", "b")])
        return pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti")

    def _led(self, live: DataFrame, turn: int) -> DataFrame:
        """For every class the leader of another component that is likest by sketch, if size and sketch allow a link."""
        choice = F.pmod("t", F.greatest(F.lit(1), F.least(F.lit(LEADERS), F.floor(F.col("m") / PER_LEADER))))
        lead = live.groupBy("t").agg(F.min(F.struct(F.xxhash64("k", choice, F.lit(turn)).alias("h"), F.col("k").alias("lk"), F.col("n").alias("ln"), F.col("pos").alias("lpos"), F.col("c").alias("lc"), F.col("sketch").alias("ls"))).alias("l")).select("t", "l.*")
        close = F.expr(f"c <> lc and 100 * least(n, ln) >= {PERCENT} * greatest(n, ln) and {100 + PERCENT} * least(n - pos, ln - lpos) >= {PERCENT} * (n + ln)")
        near = live.join(lead, "t").filter(close).withColumn("d", _differ("sketch", "ls")).filter((100 + PERCENT) * F.col("d") <= (100 - PERCENT) * (F.col("n") + F.col("ln")))
        pairs = self._untried(near.select(F.col("k").alias("a"), F.col("lk").alias("b"), "k", "d"))
        return pairs.groupBy("k").agg(F.min(F.struct("d", "a", "b")).alias("p")).select("p.a", "p.b")

    def _likest(self, pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b, d) the one of least d for every class in them."""
        both = pairs.select(F.col("a").alias("k"), "d", "a", "b").unionByName(pairs.select(F.col("b").alias("k"), "d", "a", "b"))
        return both.groupBy("k").agg(F.min(F.struct("d", "a", "b")).alias("p")).select("p.a", "p.b")

    def _between(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different components that have not been tried."""
        root = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        placed = self._untried(pairs.select("a", "b")).join(root("a"), "a", "left").join(root("b"), "b", "left")
        return placed.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")

    def _merged(self, labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """node, root after the links are taken in; links join components, so few rows are walked."""
        sc = self.scratch
        edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if labels is None:
            return components(sc, edges)
        root = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
        edges = edges.join(root("u"), "u", "left").join(root("v"), "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))
        merged = components(sc, edges)
        up = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        # Nodes that were roots, or had no label, and now have a root.
        return sc.table(moved.unionByName(merged), "labels")

    def _cleared(self, pairs: DataFrame) -> DataFrame:
        """Pairs, each once, without those of large sets that their wide sketches rule out; noted as tried."""
        side = lambda x: self.classes.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}"))
        cleared = self.scratch.table(map_arrow(pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b"), _wide_pairs, "a bigint, b bigint"), "cleared")
        self.tried = cleared if self.tried is None else self.tried.unionByName(cleared)
        return cleared

    def _linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose overlap, summed over fragments, suffices. The sets of a go to the pairs first and with them to
        the sets of b, of which there are few where b are leaders."""
        used = self._sets(pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct())
        sets = lambda x: used.join(pairs.select(F.col(x).alias("k")).distinct(), "k").toDF(x, "f", f"s{x}")
        size = lambda x: self.classes.select(F.col("k").alias(x), F.col("n").alias(f"n{x}"))
        parts = pairs.join(sets("a"), "a").join(sets("b"), ["b", "f"])
        shared = parts.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("x")).groupBy("a", "b").agg(F.sum("x").alias("x"))
        judged = shared.join(size("a"), "a").join(size("b"), "b").filter(F.expr(f"100 * x >= {PERCENT} * (na + nb - x)"))
        links = self.scratch.table(judged.select("a", "b"), "links")
        self.scratch.drop(used)
        return links

    def _sets(self, keys: DataFrame) -> DataFrame:
        """The sets, in fragments, of the given classes, made anew from one document each. The classes are counted; if
        they are few their ids go to the texts, otherwise texts and ids meet in a shuffle."""
        keys = self.scratch.table(keys.join(self.classes, "k").select(F.col("rep").alias("doc"), F.col("rep_th").alias("th"), "k"), "keys")
        few = keys.count() <= BROADCAST_ROWS
        texts = self.docs.join(F.broadcast(keys) if few else keys, ["doc", "th"]).select("k", "text")
        # Rows may be copies; the text that made the key counts once.
        return self.scratch.table(map_arrow(texts, _fragments(self.order), "k bigint, f int, s array<bigint>").dropDuplicates(["k", "f"]), "sets")

    def _across(self, live: DataFrame) -> DataFrame:
        """Candidate pairs of different components in lists that hold several. The members of a list's largest
        component need no comparing with one another; all others are held against the whole list, block by block.
        Pairs of blocks are made by number and dealt out before the blocks join them, so no task gets a whole list."""
        sc = self.scratch
        sizes = live.groupBy("t", "c").agg(F.count("*").alias("q"))
        tops = sizes.groupBy("t").agg(F.sum("q").alias("all"), F.max(F.struct("q", "c")).alias("top"))
        tops = tops.select("t", "all", (F.col("all") - F.col("top.q")).alias("rest"), F.col("top.c").alias("main"))
        open_ = sc.table(live.join(tops, "t").select("t", "k", "pos", "n", "c", "sketch", "main", "all", "rest"), "open")
        dealt = lambda total: F.pmod(F.xxhash64("k"), F.ceil(F.col(total) / F.lit(BLOCK)).cast("long"))
        member = F.struct("k", "n", "pos", "c", "sketch")
        blocks = sc.table(open_.groupBy("t", dealt("all").alias("mb")).agg(F.collect_list(member).alias("m")), "blocks")
        queries = sc.table(open_.filter("c <> main").groupBy("t", dealt("rest").alias("qb")).agg(F.first("main").alias("main"), F.collect_list(member).alias("q")), "queries")
        numbers = queries.select("t", "qb").join(blocks.select("t", "mb"), "t")
        both = numbers.join(queries, ["t", "qb"]).join(blocks, ["t", "mb"]).select("main", "q", "m")
        pairs = sc.table(self._untried(map_arrow(both, _block_pairs, "a bigint, b bigint, d bigint").distinct()), "across")
        sc.drop(open_, blocks, queries)
        return pairs


def link_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return _Join(documents).run()


def keep_one_per_component(documents: DataFrame) -> DataFrame:
    """Rows of documents whose doc_id is their component's least; the same columns."""
    ids = link_components(documents).filter(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select("doc_id").distinct()
    ids = ids.withColumnRenamed("doc_id", "_kept_id")
    column = next(c for c in documents.columns if c.lower() == "doc_id")
    return documents.join(ids, documents[column].cast("long").eqNullSafe(F.col("_kept_id")), "left_semi")


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
link AS (
  SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""


def brute(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """The contract over all pairs; for tests."""
    import re

    sets = {}
    for doc, text in rows:
        w = re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= PERCENT * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(sets[d]), find(d)) for d in ids}

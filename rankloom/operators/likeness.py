"""Pairs of alike names from an inverted index, and their greedy matching.

The likeness of two names is 1 if they are equal but for blanks or the order of words, else twice the share of
characters in matching blocks, 2m / (a + b) for lengths a and b. A likeness of f or more leaves at most
(1 - f)(a + b) characters outside the blocks, so one name becomes the other by so many deletions and insertions. A
deletion spoils q of a name's q-grams at most, an insertion q - 1: names that are alike share all q-grams but those.

So with a name's q-grams ordered rare first, two alike names that share t q-grams or more share at least l of their
first n - t + l. The index holds combinations of l of these first q-grams: names meet only where they share a
whole combination, which rare q-grams make rare. Lengths of the two decide t and l, so nothing that can be alike is
lost. Names that meet go on if their lengths and their counts of characters, 64 bits of which each deletion or
insertion changes one at most, allow the likeness; only these are compared. Equal names of a block are one class and
are compared once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..shipping import map_arrow, ship
from .components import components

#: q-grams of a combination, and combinations that a name may have before shorter ones are taken.
MOST_TOGETHER, MOST_COMBINATIONS = 4, 256
_END = "\x00"


class Bounds:
    """What lengths say of two names whose likeness is at least floor."""

    def __init__(self, floor: float):
        self.floor = floor
        # Two-grams if they always leave something shared, else single characters, which matching blocks share anyway.
        self.q = 2 if all(self._shared(a, b, 2) >= 1 for a in range(1, 65) for b in self.partners(a)) and (1 - floor) * 3 < 1 else 1
        self.level = lru_cache(None)(self._level)
        self.prefixes = lru_cache(None)(self._prefixes)

    def partners(self, a: int) -> range:
        low = next(b for b in range(a + 1) if 2 * b >= self.floor * (a + b) - 1e-9)
        high = a
        while 2 * a >= self.floor * (a + high + 1) - 1e-9:
            high += 1
        return range(max(low, 1), high + 1)

    def _shared(self, a: int, b: int, q: int) -> int:
        """q-grams that names of these lengths share at least; ends count as characters for q = 2."""
        apart = int((1 - self.floor) * (a + b) + 1e-9)
        apart -= (apart - abs(a - b)) % 2
        deleted, inserted = (apart + a - b) // 2, (apart - a + b) // 2
        return a + q - 1 - q * deleted - (q - 1) * inserted

    def shared(self, a: int, b: int) -> int:
        return max(self._shared(a, b, self.q), 1)

    def _level(self, a: int) -> int:
        """How many q-grams a combination has where the shorter name has length a."""
        for together in range(MOST_TOGETHER, 1, -1):
            first = a + self.q - 1 - min(self.shared(a, b) for b in self.partners(a) if b >= a) + together
            if first <= a + self.q - 1 and comb(first, together) <= MOST_COMBINATIONS:
                return together
        return 1

    def _prefixes(self, a: int) -> dict[int, int]:
        """For each number of q-grams in a combination, how many of the first a name of length a combines."""
        least: dict[int, int] = {}
        for b in self.partners(a):
            together = self.level(min(a, b))
            least[together] = min(least.get(together, a + 1), self.shared(a, b))
        return {together: a + self.q - 1 - t + together for together, t in least.items()}


def sketch(name: str) -> int:
    """Counts of characters, of sixteen kinds up to four each, as bits of a signed 64-bit number."""
    seen, bits = [0] * 16, 0
    for kind in (ord(c) % 16 for c in name):
        if seen[kind] < 4:
            bits |= 1 << (4 * kind + seen[kind])
            seen[kind] += 1
    return bits - (1 << 64) if bits >> 63 else bits


def _combined(floor: float):
    """c, sig, bits: hashes of the combinations that a class of names is found by, and the name's counts. grams are
    ordered rare first."""

    def run(batches):
        import pyarrow as pa

        bounds = Bounds(floor)
        for batch in batches:
            cs, sigs, bits = [], [], []
            for c, name, grams in zip(*(batch.column(x).to_pylist() for x in ("c", "name", "grams"))):
                size = len(name)
                own = {hash((together, *some)) for together, first in bounds.prefixes(size).items() for some in combinations(grams[:first], together)}
                cs += [c] * len(own)
                sigs += own
                bits += [sketch(name)] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cs, sigs, bits)], names=["c", "sig", "bits"])

    return run


def _ratios(floor: float):
    """i, j, score of pairs alike to floor or more: bounds by lengths and shared characters first, then blocks."""

    def run(batches):
        from difflib import SequenceMatcher

        import pyarrow as pa

        for batch in batches:
            matcher, last, kept = SequenceMatcher(), None, []
            for i, j, k, r in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "k", "r"))):
                if r != last:
                    matcher.set_seq2(r)
                    last = r
                matcher.set_seq1(k)
                if matcher.real_quick_ratio() >= floor and matcher.quick_ratio() >= floor and (score := matcher.ratio()) >= floor:
                    kept.append((i, j, score))
            columns = zip(*kept) if kept else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["i", "j", "score"])

    return run


def compact(c):
    return F.regexp_replace(c, r"\s", "")


def words_in_order(c):
    return F.array_join(F.array_sort(F.split(F.trim(c), r"\s+")), " ")


def candidate_pairs(scratch: Scratch, classes: DataFrame, floor: float) -> DataFrame:
    """i, j: classes (c, side 0 or 1, b, name) of side 0 and side 1 of a block that can be alike to floor or more."""
    q = Bounds(floor).q
    ends = F.concat(F.lit(_END), "name", F.lit(_END)) if q == 2 else F.col("name")
    named = classes.filter("name <> ''").select("c", "name", ends.alias("e"))
    grams = F.transform(F.sequence(F.lit(1), F.length("e") - (q - 1)), lambda p: F.substring(F.col("e"), p, F.lit(q)))
    listed = named.select("c", F.explode(grams).alias("g"))
    # Repeats of a q-gram in a name count as q-grams of their own.
    counted = listed.groupBy("c", "g").agg(F.count("*").alias("times")).select("c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"), "g")
    grams = scratch.table(counted.select("c", F.xxhash64("g", "nth").alias("g")), "grams")
    ranked = grams.join(grams.groupBy("g").agg(F.count("*").alias("n")), "g")
    ordered = ranked.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("grams")).select("c", F.col("grams.g").alias("grams"))
    signed = map_arrow(ordered.join(named.select("c", "name"), "c"), _combined(floor), "c long, sig long, bits long")
    signed = scratch.table(signed.join(classes.select("c", "side", "b", F.length("name").alias("size")), "c"), "signatures")
    left = signed.filter("side = 0").select("b", "sig", F.col("c").alias("i"), F.col("size").alias("__a"), F.col("bits").alias("__s"))
    right = signed.filter("side = 1").select("b", "sig", F.col("c").alias("j"), F.col("size").alias("__z"), F.col("bits").alias("__t"))
    least, both = F.least("__a", "__z"), F.col("__a") + F.col("__z")
    fits = (2 * least >= floor * both - 1e-9) & (F.bit_count(F.col("__s").bitwiseXOR(F.col("__t"))) <= (1 - floor) * both + 1e-9)
    return left.join(right, ["b", "sig"]).filter(fits).select("i", "j").distinct()


def alike(scratch: Scratch, classes: DataFrame, floor: float) -> DataFrame:
    """i, j, score of pairs of classes whose likeness is floor or more."""
    side = lambda s, n: classes.filter(F.col("side") == s).select("b", F.col("c").alias(n), F.col("name").alias("k" if n == "i" else "r"))
    same = None
    for key in (compact, words_in_order):
        a, z = side(0, "i").withColumn("__key", key(F.col("k"))), side(1, "j").withColumn("__key", key(F.col("r")))
        pairs = a.join(z, ["b", "__key"]).select("i", "j")
        same = pairs if same is None else same.unionByName(pairs)
    same = scratch.table(same.distinct().withColumn("score", F.lit(1.0)), "same")
    found = candidate_pairs(scratch, classes, floor).join(same.select("i", "j"), ["i", "j"], "left_anti")
    texts = found.join(side(0, "i").drop("b"), "i").join(side(1, "j").drop("b"), "j")
    return scratch.table(same.unionByName(map_arrow(texts, _ratios(floor), "i long, j long, score double")), "alike")


def _turns(least: float, margin: float):
    """Records of a component take turns, in order of id. rows: kind 0 a record (c, id), 1 a row (c, id), 2 a pair."""

    def run(table):
        import pyarrow as pa

        near: dict[int, list[tuple[float, int]]] = {}
        rows: dict[int, list] = {}
        records = []
        for kind, c, j, score, record, row in zip(*(table.column(x).to_pylist() for x in ("kind", "c", "j", "score", "record", "row"))):
            if kind == 2:
                near.setdefault(c, []).append((score, j))
            elif kind == 1:
                rows.setdefault(c, []).append(row)
            else:
                records.append((record, c))
        out = []
        for own in rows.values():
            own.sort()
        for record, c in sorted(records):
            # Of rows that score alike the greatest comes first, as in the order of (score, id) from the top.
            free = [(score, rows[j][-1], j, len(rows[j])) for score, j in near.get(c, ()) if rows.get(j)]
            if not free:
                continue
            score, row, j, n = max(free)
            second = score if n > 1 else max((s for s, _, other, _ in free if other != j), default=0.0)
            if score >= least and score - second >= margin:
                out.append((record, row, round(score, 6)))
                rows[j].pop()
        columns = zip(*out) if out else ([], [], [])
        types = (table.schema.field("record").type, table.schema.field("row").type, pa.float64())
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names=["record", "row", "score"])

    return run


def fuzzy_match(records: DataFrame, rows: DataFrame, block: str, record_id: str, record_key: str, row_id: str, row_key: str, least: float = 0.92, margin: float = 0.05) -> DataFrame:
    """record_id, row_id, score: in each block records, in order of id, take the free row of best likeness if it reaches
    `least` and leads the second best by `margin` (above 0). Pairs below least - margin can neither win nor stand in
    the way. Turns touch each other only through rows that several records are like, so each connected component of
    alike names takes its turns apart from the others.

    A row whose name stands twice or more in its block never leads by a margin: of its copies two are enough to stand
    in the way, however many there are. Records that are like such rows only are left out. Null names match nothing.
    """
    if margin <= 0:
        raise ValueError("margin must be above 0")
    spark = records.sparkSession
    ship(spark)
    scratch = Scratch(spark, "fuzzy-match")
    floor = least - margin
    a = records.select(F.lit(0).alias("side"), F.col(block).alias("b"), F.col(record_key).alias("name"), F.col(record_id).alias("record"))
    z = rows.select(F.lit(1).alias("side"), F.col(block).alias("b"), F.col(row_key).alias("name"), F.col(row_id).alias("row"))
    names = a.select("side", "b", "name").unionByName(z.select("side", "b", "name")).filter("name is not null and b is not null")
    classes = scratch.table(names.distinct().withColumn("c", F.monotonically_increasing_id()), "classes")
    pairs = alike(scratch, classes, floor)
    mine = z.join(classes, ["side", "b", "name"])
    some = mine.groupBy("c").agg(F.count("*").alias("n"), F.max("row").alias("greatest"), F.min("row").alias("least"))
    held = scratch.table(some.select("c", F.explode(F.expr("CASE WHEN n = 1 THEN array(greatest) ELSE array(least, greatest) END")).alias("row"), "n"), "held")
    # Without a row that may be taken a component has no turns to take.
    edges = pairs.select(F.col("i").alias("u"), F.col("j").alias("v"))
    roots = components(scratch, edges)
    in_root = lambda df, c: df.join(roots.select(F.col("node").alias(c), "root"), c, "left").withColumn("root", F.coalesce("root", c))
    placed = scratch.table(in_root(pairs, "i"), "placed")
    taken = scratch.table(placed.join(held.filter("n = 1").select(F.col("c").alias("j")), "j", "left_semi").select("root").distinct(), "open")
    placed = placed.join(taken, "root", "left_semi")
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    no = lambda t: F.lit(None).cast(t)
    record_type, row_type = kind(a, "record"), kind(z, "row")
    of_records = a.join(classes, ["side", "b", "name"]).join(placed.select(F.col("i").alias("c"), "root").distinct(), "c")
    of_rows = held.join(placed.select(F.col("j").alias("c"), "root").distinct(), "c")
    parts = of_records.select("root", F.lit(0).alias("kind"), "c", no("long").alias("j"), no("double").alias("score"), "record", no(row_type).alias("row"))
    parts = parts.unionByName(of_rows.select("root", F.lit(1).alias("kind"), "c", no("long").alias("j"), no("double").alias("score"), no(record_type).alias("record"), "row"))
    parts = parts.unionByName(placed.select("root", F.lit(2).alias("kind"), F.col("i").alias("c"), "j", "score", no(record_type).alias("record"), no(row_type).alias("row")))
    matched = parts.groupBy("root").applyInArrow(_turns(least, margin), f"record {record_type}, row {row_type}, score double")
    return matched.select(F.col("record").alias(record_id), F.col("row").alias(row_id), "score")

"""Joins by key, occurrence, time, interval and likeness.

None of these broadcasts by hint: Spark does so below its own size threshold, and otherwise shuffles on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shipping import ship
from . import windows
from .likeness import fuzzy_match  # noqa: F401  a join like the others here


def lookup(left: DataFrame, dimension: DataFrame, on: list[str], fallbacks: dict[str, Column | str]) -> DataFrame:
    """Left join with a dimension; a dimension column that is null takes its fallback, worked out on the left row."""
    keep = [c for c in dimension.columns if c not in on]
    dim = dimension.select(*on, *[F.col(c).alias(f"__{c}") for c in keep])
    joined = left.join(dim, on, "left")
    value = lambda c: F.coalesce(F.col(f"__{c}"), fallbacks[c] if isinstance(fallbacks[c], Column) else F.col(fallbacks[c])) if c in fallbacks else F.col(f"__{c}")
    return joined.select(*[c for c in left.columns if c not in keep], *[value(c).alias(c) for c in keep])


def guarded_lookup(left: DataFrame, dimension: DataFrame, on: list[str], value: str, guard: Column, aliases: dict[str, Column] | None = None) -> DataFrame:
    """Adds value from the dimension where guard holds; a key given in aliases is replaced by its alias first."""
    keys = {k: f"__k{i}" for i, k in enumerate(on)}
    keyed = left
    for k, name in keys.items():
        keyed = keyed.withColumn(name, (aliases or {}).get(k, F.col(k)))
    dim = dimension.select(*[F.col(k).alias(n) for k, n in keys.items()], F.col(value).alias("__v"))
    return keyed.join(dim, list(keys.values()), "left").withColumn(value, F.when(guard, F.col("__v"))).drop("__v", *keys.values())


def numbered(df: DataFrame, keys: list[str], order: list, name: str = "occurrence") -> DataFrame:
    """Numbers the rows of each key from 1 in the given order, which must be total."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def occurrence_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: list, right_order: list, how: str = "left") -> DataFrame:
    """The n-th row of a key on the left meets the n-th on the right; each row serves once."""
    a, b = numbered(left, keys, left_order, "__n"), numbered(right, keys, right_order, "__n")
    return a.join(b, [*keys, "__n"], how).drop("__n")


def occurrence_join_fallback(left: DataFrame, right: DataFrame, exact: str, loose: str, left_id: str, right_id: str, left_order: list, right_order: list) -> DataFrame:
    """left_id, right_id, tier: first occurrences are matched on the exact key, then what is left on both sides on the loose one."""
    pick = lambda df, i, k, o: df.select(F.col(i).alias("__id"), F.col(k).alias("__key"), F.struct(*o).alias("__o"))

    def tier(a: DataFrame, b: DataFrame, key: str, n: int) -> DataFrame:
        x = numbered(pick(a, left_id, key, left_order), ["__key"], ["__o"], "__n")
        y = numbered(pick(b, right_id, key, right_order), ["__key"], ["__o"], "__n")
        return x.join(y.select("__key", "__n", F.col("__id").alias("__r")), ["__key", "__n"]).select(F.col("__id").alias(left_id), F.col("__r").alias(right_id), F.lit(n).alias("tier"))

    first = tier(left, right, exact, 1)
    second = tier(left.join(first.select(left_id), left_id, "left_anti"), right.join(first.select(right_id), right_id, "left_anti"), loose, 2)
    return first.unionByName(second)


def _in_turns(table):
    """Rows of one loose key, in order: each takes the first free record of its exact key, else the first free of all."""
    from collections import defaultdict, deque

    import pyarrow as pa

    own, every, turns, used, out = defaultdict(deque), deque(), [], set(), []
    columns = [table.column(c).to_pylist() for c in ("side", "n", "exact", "left", "right")]
    for side, n, exact, left, right in sorted(zip(*columns), key=lambda x: x[:2]):
        if side:
            turns.append((exact, left))
            continue
        every.append((n, right))
        if exact is not None:
            own[exact].append((n, right))
    for exact, left in turns:
        for tier, queue in ((1, own[exact] if exact is not None else deque()), (2, every)):
            while queue and queue[0][0] in used:
                queue.popleft()
            if queue:
                n, right = queue.popleft()
                used.add(n)
                out.append((left, right, tier))
                break
    types = (table.schema.field("left").type, table.schema.field("right").type, pa.int32())
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["left", "right", "tier"])


def occurrence_join_competing(left: DataFrame, right: DataFrame, exact: str, loose: str, left_id: str, right_id: str, left_order: list, right_order: list) -> DataFrame:
    """left_id, right_id, tier: left rows take turns, in order; each takes the first right row of its exact key that is
    free (tier 1), else the first free one of its loose key (tier 2), which a later row of that exact key then misses.
    Orders must be total in a loose key; rows without a loose key match nothing. An exact key has one loose key.

    Turns touch each other within a loose key only. Where that stands for one exact key on both sides, no one takes
    another's row, and occurrences decide without turns, however many there are; only the others run key by key."""
    ship(left.sparkSession)
    side = lambda df, s, i, o: df.filter(F.col(loose).isNotNull()).select(F.lit(s).alias("side"), F.col(loose).alias("loose"), F.col(exact).alias("exact"), F.col(i).alias("id"), F.struct(*o).alias("o"))
    a, z = side(left, 1, left_id, left_order), side(right, 0, right_id, right_order)
    kinds = a.select("loose", "exact").unionByName(z.select("loose", "exact")).groupBy("loose").agg(F.min("exact").alias("__a"), F.max("exact").alias("__z"), F.count_if(F.col("exact").isNull()).alias("__n"))
    single = kinds.filter("__a = __z and __n = 0").select("loose")
    named = lambda df, n: df.select("loose", F.col("id").alias(n), F.col("o").alias(f"__o_{n}"))
    plain = occurrence_join(named(a, left_id).join(single, "loose", "left_semi"), named(z, right_id).join(single, "loose", "left_semi"), ["loose"], [f"__o_{left_id}"], [f"__o_{right_id}"], "inner")
    many = lambda df: numbered(df.join(single, "loose", "left_anti"), ["loose"], ["o"], "n")
    kind = lambda df: df.schema["id"].dataType.simpleString()
    of_left = many(a).select("loose", "side", "n", "exact", F.col("id").alias("left"), F.lit(None).cast(kind(z)).alias("right"))
    of_right = many(z).select("loose", "side", "n", "exact", F.lit(None).cast(kind(a)).alias("left"), F.col("id").alias("right"))
    turns = of_left.unionByName(of_right).groupBy("loose").applyInArrow(_in_turns, f"left {kind(a)}, right {kind(z)}, tier int")
    return plain.select(left_id, right_id, F.lit(1).alias("tier")).unionByName(turns.select(F.col("left").alias(left_id), F.col("right").alias(right_id), "tier"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], strict: bool = True, spread: bool = False) -> DataFrame:
    """Adds the values of the last right row of the key before (or, not strict, at) each left row's time. Of right rows
    at one time the one with the greatest values counts. One shuffle: both sides are put in one order and filled forward;
    spread over ranges of that order where a key may hold a large part of all rows."""
    a = left.select("*", F.col(left_time).alias("__t"), F.lit(None).cast(right.select(F.struct(*values)).schema[0].dataType).alias("__v"), F.lit(1 if not strict else 0).alias("__side"))
    b = right.groupBy(*keys, F.col(right_time).alias("__t")).agg(F.max(F.struct(*values)).alias("__v")).withColumn("__side", F.lit(0 if not strict else 1))
    both = a.unionByName(b.withColumn("__right", F.lit(True)), allowMissingColumns=True)
    filled = windows.forward_fill(both, keys, ["__t", "__side"], "__v", "__f", spread).filter("__right is null")
    return filled.select(*left.columns, *[F.col(f"__f.{v}").alias(v) for v in values])


def block_join(rows: DataFrame, starts: DataFrame, keys: list[str], row_at: str, start_at: str, values: list[str], spread: bool = False) -> DataFrame:
    """Rows between a start and the next one take the start's values; rows before the first are dropped."""
    return asof_join(rows, starts.withColumn("__is", F.lit(True)), keys, row_at, start_at, [*values, "__is"], strict=False, spread=spread).filter("__is").drop("__is")


def guarded_full_outer(left: DataFrame, right: DataFrame, key: str, left_columns: list[str], right_columns: list[str]) -> DataFrame:
    """Rows of a key that is single on both sides fuse (source 'both'); all other rows stay as they are, with their
    side. A null key never fuses. One aggregate counts both sides and holds the rows of single keys."""
    side = lambda df, cols, name, other, n: df.select(key, F.struct(*cols).alias(name), F.lit(None).cast(other.select(F.struct(*n)).schema[0].dataType).alias("__r" if name == "__l" else "__l"))
    both = side(left, left_columns, "__l", right, right_columns).unionByName(side(right, right_columns, "__r", left, left_columns))
    g = both.groupBy(key).agg(F.count("__l").alias("__nl"), F.count("__r").alias("__nr"), F.max("__l").alias("__l"), F.max("__r").alias("__r"))
    single = g.filter(F.col(key).isNotNull() & (F.col("__nl") == 1) & (F.col("__nr") == 1))
    rest = both.join(single.select(key), key, "left_anti")
    source = F.when(F.col("__l").isNull(), "right").otherwise("left")
    out = single.select(key, "__l", "__r", F.lit("both").alias("source")).unionByName(rest.select(key, "__l", "__r", source.alias("source")))
    return out.select(key, *[F.col(f"__l.{c}").alias(c) for c in left_columns], *[F.col(f"__r.{c}").alias(c) for c in right_columns], "source")


def top_with_margin(scored: DataFrame, key: str, candidate: str, score: str, least: float, margin: float) -> DataFrame:
    """key, candidate, score of the best candidate where it is good enough and ahead of the second; ties have no winner."""
    w = W.partitionBy(key).orderBy(F.desc(score), candidate)
    two = scored.withColumn("__n", F.row_number().over(w)).filter("__n <= 2")
    best = two.groupBy(key).agg(F.max(F.when(F.col("__n") == 1, F.struct(candidate, score))).alias("b"), F.max(F.when(F.col("__n") == 2, F.col(score))).alias("second"))
    ok = (F.col(f"b.{score}") >= least) & (F.col(f"b.{score}") - F.coalesce("second", F.lit(0.0)) >= margin)
    return best.filter(ok).select(key, F.col(f"b.{candidate}").alias(candidate), F.col(f"b.{score}").alias(score))


def likest_with_margin(rows: DataFrame, blocks: list[str], row_id: str, name: str, least: float, margin: float) -> DataFrame:
    """row_id, b, score: for each row the likest other row of its block, by 1 - levenshtein / greater length, if it is
    good enough and ahead of the second by the margin (above 0), as top_with_margin over all pairs gives it.

    Names are compared once for each block, not once for each pair of rows: a name that two other rows have is as like
    as itself and never leads, so counts and the least and greatest id of a name say all. Pairs below least - margin can
    neither win nor stand in the way. Work grows with the square of a block's different names, not of its rows. An id
    that several rows have goes through the pairs of rows, since its rows are no candidates of each other."""
    if margin <= 0:
        raise ValueError("margin must be above 0")
    known = rows.select(*blocks, F.col(row_id).alias("__a"), F.col(name).alias("__k")).dropna()
    classes = known.groupBy(*blocks, "__k").agg(F.count("*").alias("__n"), F.min("__a").alias("__first"), F.max("__a").alias("__last"))
    size = F.nullif(F.greatest(F.length("__k"), F.length("__r")), F.lit(0))  # two empty names have no likeness
    score = 1 - F.levenshtein("__k", "__r") / size
    floor = least - margin - 1e-9
    # Names of three rows or more have no winner; those of two have each other, and a second among the other names.
    mine = classes.filter("__n <= 2").withColumnRenamed("__n", "__own")
    other = classes.select(*blocks, F.col("__k").alias("__r"), F.col("__n"), F.col("__first").alias("__b"))
    near = mine.select(*blocks, "__k").join(other.hint("merge"), blocks).filter("__k <> __r").filter(1 - F.abs(F.length("__k") - F.length("__r")) / size >= floor)
    near = near.withColumn("__s", score).filter(F.col("__s") >= floor)
    w = W.partitionBy(*blocks, "__k").orderBy(F.desc("__s"), "__b")
    two = near.withColumn("__at", F.row_number().over(w)).filter("__at <= 2")
    at = lambda n, v: F.max(F.when(F.col("__at") == n, v))
    best = two.groupBy(*blocks, "__k").agg(at(1, F.struct("__s", "__b", "__n")).alias("__x"), at(2, F.col("__s")).alias("__y"))
    found = mine.join(best, [*blocks, "__k"], "left")
    alone = F.struct(F.col("__first").alias("a"), F.col("__x.__b").alias("b"), F.col("__x.__s").alias("s"), F.when(F.col("__x.__n") > 1, F.col("__x.__s")).otherwise(F.col("__y")).alias("second"))
    copy = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"), F.lit(1.0).alias("s"), F.col("__x.__s").alias("second"))
    first = F.explode(F.when(F.col("__own") == 1, F.array(alone)).when(F.length("__k") > 0, F.array(copy("__first", "__last"), copy("__last", "__first"))))
    won = found.select(first.alias("w")).select("w.*").filter((F.col("s") >= least) & (F.col("s") - F.coalesce("second", F.lit(0.0)) >= margin))
    repeated = known.groupBy("__a").agg(F.count("*").alias("__m")).filter("__m > 1").select("__a")
    once = won.join(repeated, F.col("a") == F.col("__a"), "left_anti").select("a", "b", F.col("s").alias("score"))
    pairs = known.join(repeated, "__a", "left_semi").join(known.select(*blocks, F.col("__a").alias("b"), F.col("__k").alias("__r")).hint("merge"), blocks)
    pairs = pairs.filter("__a <> b").select(F.col("__a").alias("a"), "b", score.alias("score"))
    return once.unionByName(top_with_margin(pairs, "a", "b", "score", least, margin)).withColumnRenamed("a", row_id)


def cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[list[str]]) -> DataFrame:
    """left_id, right_id, tier of the first tier of key columns on which a left row has exactly one right row; a tier
    with several is ambiguous and leaves the row to the next. Keys that hold nulls never match. Each tier is one join
    more on the same rows, so the plan grows with the number of tiers only."""
    found = left
    for n, keys in enumerate(tiers, 1):
        one = right.groupBy(*keys).agg(F.count_distinct(right_id).alias("__n"), F.min(right_id).alias(f"__r{n}")).filter("__n = 1").drop("__n")
        found = found.join(one, keys, "left")
    hits = [F.when(F.col(f"__r{n}").isNotNull(), F.struct(F.col(f"__r{n}").alias("r"), F.lit(n).alias("tier"))) for n in range(1, len(tiers) + 1)]
    return found.select(left_id, F.coalesce(*hits).alias("__h")).filter("__h is not null").select(left_id, F.col("__h.r").alias(right_id), F.col("__h.tier").alias("tier"))


def update_columns(base: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Replaces columns for keys that updates has, with null too; other keys of updates are ignored."""
    new = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    joined = base.join(new, key, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def override_rows(base: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Whole rows of overrides replace those of their key; keys that base lacks are added. Same columns."""
    return base.join(overrides.select(key), key, "left_anti").select(*base.columns).unionByName(overrides.select(*base.columns))


def propagate(rows: DataFrame, source: DataFrame, keys: list[str], column: str, inherits: Column) -> DataFrame:
    """Rows for which inherits holds take the column from source by key, all others get null."""
    src = source.select(*keys, F.col(column).alias("__v"))
    return rows.join(src, keys, "left").withColumn(column, F.when(inherits, F.col("__v"))).drop("__v").select(*rows.columns)


def not_seen(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    return df.join(ledger.select(key), key, "left_anti")


def not_seen_elsewhere(df: DataFrame, ledger: DataFrame, content: str, key: str) -> DataFrame:
    """Drops rows whose content is in the ledger under another key."""
    other = ledger.select(F.col(content).alias("__c"), F.col(key).alias("__k"))
    return df.join(other, (F.col(content) == F.col("__c")) & (F.col(key) != F.col("__k")), "left_anti")


def groups_with_all(df: DataFrame, group: str, column: str, needed: list) -> DataFrame:
    """Groups in which every needed value occurs."""
    return df.filter(F.col(column).isin(*needed)).groupBy(group).agg(F.count_distinct(column).alias("__n")).filter(F.col("__n") == len(set(needed))).select(group)

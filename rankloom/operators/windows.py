"""Ordered analytics within groups: sums, counts ahead, gaps, blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import folded
from ..scratch import Scratch


def _upto(keys: list[str], order: list, last: int = 0):
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, last)


def running_sum(df: DataFrame, keys: list[str], order: list, contribution: Column, name: str) -> DataFrame:
    """The sum of contributions up to and with each row; null for rows that contribute nothing."""
    c = F.coalesce(contribution, F.lit(0))
    return df.withColumn(name, F.when(c > 0, F.sum(c).over(_upto(keys, order))))


def counts_ahead(refs: DataFrame, events: DataFrame, keys: list[str], ref_order: str, event_order: str, pivot: str, values: dict) -> DataFrame:
    """Adds, for each name in values, the number of events of that pivot value with a lower order and the same keys.
    Orders are whole numbers. Events are counted by order first, so many events at one place are one row."""
    per = events.groupBy(*keys, F.col(event_order).alias("__t")).agg(*[F.count_if(F.col(pivot) == v).alias(f"__{n}") for n, v in values.items()])
    both = refs.withColumn("__t", F.col(ref_order)).withColumn("__ref", F.lit(True)).unionByName(per, allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy("__t").rangeBetween(W.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(f"__{n}").over(w), F.lit(0)).alias(n) for n in values]
    return both.select("*", *sums).filter("__ref").select(*refs.columns, *values)


def spread_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The sum of values up to and with each row, for keys that may hold a large part of all rows: ranges of (keys,
    order) are summed apart, then moved on by the sums of the key's ranges before. The order must be total, or rows
    alike in it share a range and any order among them. The ranges are written once, as their bounds are sampled."""
    ranged = Scratch(df.sparkSession, "spread-sum").table(df.withColumn("__v", value).repartitionByRange(*keys, *order).withColumn("__p", F.spark_partition_id()), "ranged")
    local = ranged.withColumn("__s", F.sum("__v").over(_upto(["__p", *keys], order)))
    per = ranged.groupBy("__p", *keys).agg(F.sum("__v").alias("__t"))
    # A row for each range of a key: a key has no more of them than there are ranges.
    before = per.withColumn("__b", F.coalesce(F.sum("__t").over(_upto(keys, ["__p"], -1)), F.lit(0))).select(F.col("__p").alias("__q"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__b")
    same = F.col("__p") == F.col("__q")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return local.join(before, same).select(*df.columns, (F.col("__s") + F.col("__b")).alias(name))


def spread_last(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """The last value of column that is not null, up to and with each row, for keys that may hold a large part of all
    rows: ranges of (keys, order) are filled apart, then a range's rows before its first value take the last value of
    the key's ranges before. As spread_sum, the order must be total where values differ."""
    ranged = Scratch(df.sparkSession, "spread-last").table(df.repartitionByRange(*keys, *order).withColumn("__p", F.spark_partition_id()), "ranged")
    local = ranged.withColumn("__l", F.last(column, ignorenulls=True).over(_upto(["__p", *keys], order)))
    per = ranged.groupBy("__p", *keys).agg(F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order))).alias("__t"))
    # A row for each range of a key: a key has no more of them than there are ranges.
    carried = per.withColumn("__b", F.last("__t", ignorenulls=True).over(_upto(keys, ["__p"], -1))).select(F.col("__p").alias("__q"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__b")
    same = F.col("__p") == F.col("__q")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    kept = [c for c in df.columns if c != name]
    return local.join(carried, same).select(*kept, F.coalesce("__l", "__b").alias(name)).select(*df.columns, *([] if name in df.columns else [name]))


def ordinal(df: DataFrame, keys: list[str], order: list, name: str = "ordinal", spread: bool = False) -> DataFrame:
    """Numbers from 1; spread where a key may hold a large part of all rows."""
    return spread_sum(df, keys, order, F.lit(1), name) if spread else df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def active_rank(df: DataFrame, keys: list[str], order: list, active: Column, name: str, spread: bool = False) -> DataFrame:
    """One more than the number of active rows strictly before; the row itself always counts as one. Spread where a key
    may hold a large part of all rows."""
    if spread:
        flagged = df.withColumn("__active", F.when(active, 1).otherwise(0))
        return spread_sum(flagged, keys, order, F.col("__active"), name).withColumn(name, F.col(name) - F.col("__active") + 1).drop("__active")
    before = F.sum(F.when(active, 1).otherwise(0)).over(_upto(keys, order, -1))
    return df.withColumn(name, F.lit(1) + F.coalesce(before, F.lit(0)))


def gaps(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows whose position does not follow the one before (0 before the first), with the expected position."""
    w = W.partitionBy(*keys).orderBy(position)
    expected = F.lag(position, 1, 0).over(w) + 1
    return df.withColumn("expected", expected).filter(F.col(position) != F.col("expected"))


def incomplete(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Groups whose positions are not 1 to n, each once."""
    g = df.groupBy(*keys).agg(F.min(position).alias("low"), F.max(position).alias("high"), F.count("*").alias("n"), F.count_distinct(position).alias("n_distinct"))
    return g.filter("low <> 1 or high <> n or n_distinct <> n")


def blocks_by_start(df: DataFrame, keys: list[str], order: list, starts: Column, name: str = "block") -> DataFrame:
    """Numbers blocks that a start opens; rows before the first start are dropped."""
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(_upto(keys, order))).filter(F.col(name) > 0)


def blocks_by_end(df: DataFrame, keys: list[str], order: list, ends: Column, name: str = "block") -> DataFrame:
    """Numbers blocks, from 0, that an end row closes; rows after the last end form a block of their own."""
    return df.withColumn(name, F.coalesce(F.sum(F.when(ends, 1).otherwise(0)).over(_upto(keys, order, -1)), F.lit(0)))


def forward_fill(df: DataFrame, keys: list[str], order: list, column: str, name: str | None = None, spread: bool = False) -> DataFrame:
    """The last value that is not null up to each row; spread where a key may hold a large part of all rows."""
    if spread:
        return spread_last(df, keys, order, column, name or column)
    return df.withColumn(name or column, F.last(column, ignorenulls=True).over(_upto(keys, order)))


def first_in_group(df: DataFrame, keys: list[str], order: list, column: str, name: str) -> DataFrame:
    """The first value of the group that is not null, for all its rows."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return df.withColumn(name, F.first(column, ignorenulls=True).over(w))


def newest_only(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    return df.withColumn("__m", F.max(date).over(W.partitionBy(*keys))).filter(F.col(date) == F.col("__m")).drop("__m")


def preferred_only(df: DataFrame, keys: list[str], preferred: Column) -> DataFrame:
    """Where a group has preferred rows only these stay, otherwise all."""
    flagged = df.withColumn("__p", F.coalesce(preferred, F.lit(False)))
    return flagged.withColumn("__any", F.max("__p").over(W.partitionBy(*keys))).filter(F.col("__p") == F.col("__any")).drop("__p", "__any")


def or_else(first: DataFrame, second: DataFrame) -> DataFrame:
    """first, or second if first has no rows: one plan, no action."""
    probe = first.limit(1).agg(F.count("*").alias("__n"))  # one row
    return first.unionByName(second.join(probe).filter("__n = 0").drop("__n"))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int = 1) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= k).drop("__n")


def text_order(df: DataFrame, keys: list[Column], name: str = "place") -> DataFrame:
    """Places in the order of keys, nulls last, for the whole table: ranges are sorted apart, then numbered on from
    each other by their counts, so no task holds the whole. The ranges are written once with their numbers: were they
    made for the counts and for the rows apart, they could differ, and rows would meet the wrong counts or none."""
    order = [k.asc_nulls_last() for k in keys]
    ranged = Scratch(df.sparkSession, "text-order").table(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranged")
    local = ranged.withColumn("__n", F.row_number().over(W.partitionBy("__p").orderBy(*order)))
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__c"))
    before = sizes.select("__p", F.coalesce(F.sum("__c").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__s"))  # a row for each range
    return local.join(F.broadcast(before), "__p").withColumn(name, F.col("__n") + F.col("__s")).drop("__p", "__n", "__s")


def name_order(df: DataFrame, name: str, seq: str, place: str = "place") -> DataFrame:
    """Places by display name without accents or case; of equal names in the order of seq."""
    return text_order(df, [folded(F.col(name)), F.col(seq)], place)

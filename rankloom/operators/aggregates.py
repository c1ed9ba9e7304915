"""Aggregations with stated tie rules. All are combinable before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: Column, columns: list[str], aggregate) -> DataFrame:
    best = df.groupBy(*keys).agg(aggregate(F.struct(order.alias("o"), F.struct(*columns).alias("v"))).alias("b"))
    return best.select(*keys, *[F.col(f"b.v.{c}").alias(c) for c in columns])


def argmax_first(df: DataFrame, keys: list[str], value: str, seq: str, columns: list[str]) -> DataFrame:
    """The row of greatest value in each group; of equals the earliest. Nulls of value rank lowest."""
    return _pick(df, keys, F.struct(F.col(value).alias("a"), (-F.col(seq)).alias("b")), columns, F.max)


def argmax_last(df: DataFrame, keys: list[str], value: str, seq: str, columns: list[str]) -> DataFrame:
    """As argmax_first, but of equals the latest."""
    return _pick(df, keys, F.struct(F.col(value).alias("a"), F.col(seq).alias("b")), columns, F.max)


def distinct_first(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    return _pick(df, keys, F.struct(*order), columns, F.min)


def distinct_last(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    return _pick(df, keys, F.struct(*order), columns, F.max)


def filtered_argmax(df: DataFrame, keys: list[str], order: list[str], value: str, filters: dict[str, Column | None]) -> DataFrame:
    """For each name the value of the last row that its filter lets through, all in one pass."""
    o = F.struct(*order)
    return df.groupBy(*keys).agg(*[F.max_by(value, F.when(f, o) if f is not None else o).alias(n) for n, f in filters.items()])


def rollup_levels(df: DataFrame, outer: str, inner: str, count: str = "n", known: list | None = None) -> DataFrame:
    """level, outer, inner, count for: inner; (outer, inner); outer; all. Rows whose outer value is not among known
    count only in the first and the last."""
    rows = df.withColumn("__o", F.when(F.col(outer).isin(*known), F.col(outer)) if known else F.col(outer))
    sets = rows.groupingSets([["__o", inner], ["__o"], [inner], []], "__o", inner).agg(F.count("*").alias(count), F.grouping("__o").alias("go"), F.grouping(inner).alias("gi"))
    level = F.when((F.col("go") == 1) & (F.col("gi") == 1), "all").when(F.col("go") == 1, inner).when(F.col("gi") == 1, outer).otherwise(f"{outer},{inner}")
    kept = sets.filter((F.col("go") == 1) | F.col("__o").isNotNull())
    return kept.select(level.alias("level"), F.col("__o").alias(outer), inner, count)


def count_where(df: DataFrame, keys: list[str], counts: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def duplicates(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys with several rows: their number and the first two places."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(order)).alias("__o")).filter("n > 1")
    return g.select(*keys, "n", F.get("__o", F.lit(0)).alias("first"), F.get("__o", F.lit(1)).alias("second"))


def merged_attributes(df: DataFrame, keys: list[str], sets: list[str], ranked: dict[str, dict[str, int]], least: dict[str, str], most: dict[str, str]) -> DataFrame:
    """Sorted distinct values of `sets`, the highest of each ranked column (name -> ranks), least and greatest of others."""
    aggs = [F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c) for c in sets]
    for c, ranks in ranked.items():
        rank = F.try_element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col(c))
        aggs.append(F.max_by(c, rank).alias(f"highest_{c}"))
    aggs += [F.min(c).alias(n) for n, c in least.items()] + [F.max(c).alias(n) for n, c in most.items()]
    return df.groupBy(*keys).agg(*aggs)


def ambiguous(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n_values")).filter("n_values > 1")


def profile_count(df: DataFrame, key: str, within: str) -> DataFrame:
    """For each key the greatest number of its rows within one value of another column."""
    return df.groupBy(key, within).agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("profiles"))


def sorted_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """counts: a map of value to count for each group, in order of value; empty groups don't occur."""
    per = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "n")))).alias("counts"))


def reason_counts(df: DataFrame, parts: list[str], reason: str, batch: str) -> DataFrame:
    """key ('part:part:reason') and n. A batch that counts a key again overwrites what earlier ones counted."""
    per = df.groupBy(*parts, reason, batch).agg(F.count("*").alias("n"))
    last = per.groupBy(*parts, reason).agg(F.max_by("n", batch).alias("n"))
    return last.select(F.concat_ws(":", *parts, reason).alias("key"), "n")


def document_summary(df: DataFrame, document: str, code: str, counted: Column, owned: Column) -> DataFrame:
    """Per document: records, counted rows, those of them that are not owned, those that are, and a map of the owned by
    code, in order of code."""
    c, mine = F.coalesce(counted, F.lit(False)), F.coalesce(owned, F.lit(False))
    per = df.groupBy(document, code).agg(F.count("*").alias("__r"), F.count_if(c).alias("__c"), F.count_if(c & mine).alias("__o"))
    g = per.groupBy(document).agg(F.sum("__r").alias("records"), F.sum("__c").alias("counted"), F.sum("__o").alias("owned"), F.array_sort(F.collect_list(F.when(F.col("__o") > 0, F.struct(F.col(code).alias("key"), F.col("__o").alias("value"))))).alias("__m"))
    return g.select(document, "records", "counted", (F.col("counted") - F.col("owned")).alias("excluded"), "owned", F.map_from_entries("__m").alias("counts"))


def occupancy(df: DataFrame, code: str, contribution: Column) -> DataFrame:
    """The sum of contributions of each code, which is the last value of its running sum; 0 where nobody contributes."""
    return df.groupBy(code).agg(F.coalesce(F.sum(contribution), F.lit(0)).cast("long").alias("total"))

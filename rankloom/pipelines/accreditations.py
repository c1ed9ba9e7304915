"""Accreditations: a cumulative table of persons, and the ranks that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import LEVELS
from ..functions.text import display_name, identity_key
from ..operators import merge
from .positions import english_positions

STATE = "key string, official_name string, levels array<string>, provinces array<string>, sources array<string>, first_date string, latest_date string"


def merged(state: DataFrame, records: DataFrame) -> DataFrame:
    """state after records (official_name, level, province, source_url, date): sets grow, dates widen; a person keeps the
    name first given. Merging the same records again changes nothing."""
    one = records.select(
        identity_key(F.col("official_name")).alias("key"), "official_name", F.array("level").alias("levels"), F.array("province").alias("provinces"),
        F.array_compact(F.array("source_url")).alias("sources"), F.col("date").alias("first_date"), F.col("date").alias("latest_date"),
    )
    both = state.withColumn("__b", F.lit(0)).unionByName(one.withColumn("__b", F.lit(1)))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    first = F.min(F.struct("__b", F.coalesce("first_date", F.lit("")).alias("d"), "official_name")).alias("f")
    g = both.groupBy("key").agg(first, union("levels"), union("provinces"), union("sources"), F.min("first_date").alias("first_date"), F.max("latest_date").alias("latest_date"))
    return g.withColumn("official_name", F.col("f.official_name")).select(*state.columns)


def published(state: DataFrame) -> DataFrame:
    """The columns that are published; of levels the highest too."""
    rank = F.create_map(*[F.lit(x) for kv in LEVELS.items() for x in kv])
    highest = F.array_max(F.transform("levels", lambda x: F.struct(F.coalesce(F.try_element_at(rank, x), F.lit(0)).alias("r"), x.alias("l"))))["l"]
    return state.select("official_name", display_name(F.col("official_name")).alias("display_name"), highest.alias("highest_level"), "levels", "provinces", "first_date", "latest_date")


def run(state: DataFrame, records: DataFrame, positions: DataFrame) -> dict[str, DataFrame]:
    """state and what follows from it: changes (key, change), and positions with their ranks worked out anew."""
    after = merged(state, records)
    return {"state": after, "changes": merge.changes(state, after, ["key"]), "positions": english_positions(positions, after)}

"""Positions: persons found on lists, and ranks derived from credentials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ranks
from ..functions.text import compact_key, identity_key
from ..operators import aggregates, windows


def resolve_profiles(assignments: DataFrame, profiles: DataFrame, previous: DataFrame, mode: str) -> DataFrame:
    """id, profile, tier: the one profile that an assignment can mean; assignments without one are absent.

    assignments: id, candidate_name, specialty_code, body, cut. profiles: profile, official_name, specialty_code, body,
    after_order (nullable). previous: profile, candidate_name, specialty_code of earlier assignments.
    Candidates agree in code and body and in identity or, if none does, in identity without blanks. Of candidates the
    one whose after_order is the cut is meant. Else, at the start of a year, the one profile of code and body with that
    order, then the one candidate without an order; in the course, the one candidate, then the one candidate with an
    earlier assignment of that name and code.

    Both sides grow, and names and ids take little room in files but much in memory, so none is broadcast."""
    a = assignments.select("id", F.col("specialty_code").alias("code"), "body", "cut", identity_key(F.col("candidate_name")).alias("name"), compact_key(F.col("candidate_name")).alias("compact"))
    p = profiles.select("profile", F.col("specialty_code").alias("code"), "body", "after_order", identity_key(F.col("official_name")).alias("name"), compact_key(F.col("official_name")).alias("compact"))
    named = a.join(p.drop("compact").hint("merge"), ["code", "body", "name"]).select("id", "profile", "after_order")
    unnamed = a.join(named.select("id").hint("merge"), "id", "left_anti")
    loose = unnamed.join(p.drop("name").hint("merge"), ["code", "body", "compact"]).select("id", "profile", "after_order")
    before = previous.select("profile", F.col("specialty_code").alias("code"), identity_key(F.col("candidate_name")).alias("name"), F.lit(True).alias("earlier")).distinct()
    candidates = named.unionByName(loose).join(a.select("id", "code", "name", "cut").hint("merge"), "id").join(before.hint("merge"), ["profile", "code", "name"], "left")
    one = lambda test: F.when(F.count_if(test) == 1, F.max(F.when(test, F.col("profile"))))
    per = candidates.groupBy("id").agg(
        one(F.col("after_order") == F.col("cut")).alias("exact"), one(F.col("after_order").isNull()).alias("unranked"), one(F.lit(True)).alias("only"), one(F.coalesce("earlier", F.lit(False))).alias("repeated")
    )
    ranked = p.filter("after_order is not null").groupBy("code", "body", F.col("after_order").alias("cut")).agg(F.when(F.count("*") == 1, F.max("profile")).alias("ranked"))
    found = a.join(per.hint("merge"), "id", "left").join(ranked.hint("merge"), ["code", "body", "cut"], "left")
    tiers = ("exact", "ranked", "unranked") if mode == "inicio" else ("exact", "only", "repeated")
    hit = F.coalesce(*[F.when(F.col(t).isNotNull(), F.struct(F.col(t).alias("profile"), F.lit(t).alias("tier"))) for t in tiers])
    return found.select("id", hit.alias("h")).filter("h is not null").select("id", "h.profile", "h.tier")


def english_positions(positions: DataFrame, accredited: DataFrame) -> DataFrame:
    """positions (person_index, official_name, specialty_code, after, masters boolean) with english_position: on the
    lists that count credentials, the sum up to and with a person of one for the English specialty and one for an
    accreditation; null for persons with neither, without an order or of another body. accredited: official_name."""
    named = accredited.select(identity_key(F.col("official_name")).alias("__key")).distinct().withColumn("__acc", F.lit(True))
    has = positions.groupBy("person_index").agg(F.max(F.col("specialty_code") == ranks.ENGLISH_SPECIALTY).alias("__has"))
    rows = positions.withColumn("__key", identity_key(F.col("official_name"))).join(named, "__key", "left").join(has, "person_index")
    counts = F.col("masters") & F.col("specialty_code").isin(*ranks.ENGLISH_CODES) & F.col("after").isNotNull()
    points = F.when(counts, ranks.english_contribution(F.col("__has"), F.col("__acc"))).otherwise(0)
    # The lists are few and long: their sums are spread over ranges.
    summed = windows.spread_sum(rows.withColumn("__points", points), ["specialty_code"], ["after", "person_index"], F.col("__points"), "__sum")
    return summed.select(*positions.columns, F.when(F.col("__points") > 0, F.col("__sum")).alias("english_position"))


def english_totals(positions: DataFrame) -> DataFrame:
    """specialty_code, total of the lists that count credentials."""
    own = positions.filter(F.col("specialty_code").isin(*ranks.ENGLISH_CODES))
    return aggregates.occupancy(own.groupBy("specialty_code").agg(F.max("english_position").alias("n")), "specialty_code", F.col("n"))

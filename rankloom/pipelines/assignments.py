"""Assignments of a school year: for each profile (a person on a list) the award that holds, kept through the course.

Awards have the columns of schemas.AWARDS and url, sha256, published_date, seq (place in their document). Profiles:
person_index, position_index, official_name, specialty_code, body, after_order, initial_order. The state has the
columns of schemas.ASSIGNMENTS, skipped has mode, body, reason and n (of the last document that had the reason).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import calendar, classify
from ..functions.text import identity_key
from ..schemas import ASSIGNMENTS, names_of
from ..scratch import Scratch
from .positions import resolve_profiles

SKIPPED = "mode string, body string, reason string, n long"
_WHO = F.struct("person_index", "position_index")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the key that an assignment is kept by: its profile, else who got what by name."""
    of_profile = F.array(F.lit("profile"), F.col("person_index").cast("string"), F.col("position_index").cast("string"))
    by_name = F.array(F.lit("name"), "body", "specialty_code", F.col("after_order").cast("string"), identity_key(F.col("candidate_name")))
    return rows.withColumn("__key", F.when((F.col("person_index") >= 0) & (F.col("position_index") >= 0), of_profile).otherwise(by_name))


def resolve_document(awards: DataFrame, profiles: DataFrame, state: DataFrame, mode: str, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """A document's assignments, and why others were left out (reason, n). At the start of a year an award without a
    profile is kept by name; in the course it is left out. Of awards of one profile the first stays. Both come from one
    table of what was made of each award, which is written where scratch is given."""
    province = F.element_at(F.create_map(*[F.lit(x) for kv in classify.PROVINCES.items() for x in kv]), F.substring("center_code", 1, 2))
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    given = awards.withColumns({"id": F.col("seq"), "province_index": province, "specialty_code": text("specialty_code"), "candidate_name": text("candidate_name"), "body": text("body"), "cut": F.coalesce("cut", F.lit(0))})
    early = F.when(F.col("specialty_code") == "", "without_specialty").when(F.col("province_index").isNull(), "unknown_province")
    given = given.withColumn("reason", early)
    usable = given.filter("reason is null").drop("reason")
    previous = state.filter("person_index >= 0").select(_WHO.alias("profile"), "candidate_name", "specialty_code")
    known = profiles.withColumn("profile", _WHO)
    found = resolve_profiles(usable, known, previous, mode).select("id", "profile")
    facts = known.select("profile", F.col("body").alias("__body"), F.col("after_order").alias("__after"), "initial_order")
    joined = usable.join(found.hint("merge"), "id", "left").join(facts.hint("merge"), "profile", "left").withColumn("__has", F.col("profile").isNotNull())
    start = mode == "inicio"
    rows = joined.select(
        "id", "__has", F.coalesce("__body", "body").alias("body"), "specialty_code", F.coalesce("profile.person_index", F.lit(-1)).alias("person_index"), F.coalesce("profile.position_index", F.lit(-1)).alias("position_index"),
        (F.col("cut") if start else F.col("__after")).alias("after_order"), "initial_order", text("center_code"), "province_index", text("published_date"), F.lit(mode).alias("mode"), text("placement_type"), "candidate_name",
        text("url").alias("source_url"), text("sha256").alias("source_sha256"), "workload", F.coalesce("english_requirement", F.lit(False)).alias("english_requirement"), F.coalesce("itinerant", F.lit(False)).alias("itinerant"), text("center_name"), text("locality"),
    )
    keys = ["__key"] if start else ["__key", "__has"]
    once = _keyed(rows).withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy("id")))
    kept = F.lit(True) if start else F.col("__has")
    nameless = F.when(~F.col("__has"), "initial_position_without_profile" if start else "without_unique_profile")
    twice = F.when(kept & (F.col("__n") > 1), "duplicate_assignment")
    whole = [F.col(c).cast("int").alias(c) if c in ("person_index", "position_index", "after_order", "initial_order", "province_index") else F.col(c) for c in names_of(ASSIGNMENTS)]
    judged = once.select(*whole, (kept & (F.col("__n") == 1)).alias("__stays"), F.array_compact(F.array(nameless, twice)).alias("__reasons"))
    judged = judged.unionByName(given.filter("reason is not null").select(F.lit(False).alias("__stays"), F.array("reason").alias("__reasons")), allowMissingColumns=True)
    judged = scratch.table(judged, "judged") if scratch else judged
    skipped = judged.select(F.explode("__reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    return judged.filter("__stays").drop("__stays", "__reasons"), skipped


def merge_document(state: DataFrame, resolved: DataFrame, body: str, mode: str) -> DataFrame:
    """The state after a document. At the start of a year it replaces its body's assignments; in the course it replaces
    those of its keys, unless what is held is of a later date."""
    held = state.filter(F.col("body") != body) if mode == "inicio" else state
    both = _keyed(held.withColumn("__new", F.lit(0)).unionByName(resolved.withColumn("__new", F.lit(1))))
    order = [F.desc("__new")] if mode == "inicio" else [F.desc(F.coalesce("published_date", F.lit(""))), F.desc("__new")]
    return both.withColumn("__n", F.row_number().over(W.partitionBy("__key").orderBy(*order))).filter("__n = 1").select(*state.columns)


def run(state: DataFrame, skipped: DataFrame, awards: DataFrame, profiles: DataFrame, year: str, state_year: str | None, mode: str) -> dict:
    """One update; state, skipped and state_year after it. Documents of another school year than the lists' are left
    out, and so are those of the course while the state is of another year; the first document of a start empties such a
    state. Documents are taken one after the other, by date and body, since a name that leaves several profiles open is
    settled by what the documents before have given it; each is a table job, and a run has few of them."""
    spark = awards.sparkSession
    scratch = Scratch(spark, "assignments")
    dated = awards.withColumn("__day", F.when(F.col("published_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("published_date").try_cast("date")))
    own = scratch.table(dated.filter(calendar.school_year(F.col("__day")) == year).drop("__day"), "awards")
    if mode != "inicio" and state_year != year:
        return {"state": state, "skipped": skipped, "state_year": state_year}
    documents = own.groupBy("url").agg(F.max("published_date").alias("date"), F.max(F.coalesce("body", F.lit(""))).alias("body")).collect()  # a row for each new document
    names = names_of(ASSIGNMENTS)
    for d in sorted(documents, key=lambda r: (r["date"], r["body"], r["url"])):
        if state_year != year:
            state, skipped, state_year = spark.createDataFrame([], ASSIGNMENTS), spark.createDataFrame([], SKIPPED), year
        resolved, reasons = resolve_document(own.filter(F.col("url").eqNullSafe(F.lit(d["url"]))), profiles, state, mode, scratch)
        state = scratch.table(merge_document(state.select(*names), resolved, d["body"], mode), "state")
        counted = reasons.select(F.lit(mode).alias("mode"), F.lit(d["body"]).alias("body"), "reason", "n")
        skipped = scratch.table(skipped.join(counted, ["mode", "body", "reason"], "left_anti").select(*counted.columns).unionByName(counted), "skipped")
    return {"state": state, "skipped": skipped, "state_year": state_year}

"""Cuts: the last rank awarded for each centre and specialty, at the start of a year and through its course.

Awards have the columns of schemas.AWARDS and url, sha256, published_date, seq (place in their document).
Cut rows have center_code, specialty_code, cut, specialty_name, center_name, municipality, body, placement_type,
english_requirement, itinerant, and origin, school_year, published_date, url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, classify
from ..functions.text import display_place, folded, smart_title
from ..operators import aggregates, joins, merge
from ..scratch import Scratch

KEYS = ["center_code", "specialty_code", "body"]


def owned(awards: DataFrame) -> DataFrame:
    """Awards of specialties that belong to their document's body."""
    return awards.filter(classify.owner(F.col("specialty_code")) == F.col("body"))


def document_cuts(awards: DataFrame, centres: DataFrame, today: Column | None = None) -> DataFrame:
    """Per document, centre and specialty the award of greatest cut, the first of equals, with the centre's published
    name and place where the guide has it. A document without a date belongs to the school year of today."""
    columns = ["cut", "specialty_name", "center_name", "locality", "placement_type", "english_requirement", "itinerant", "published_date", "sha256", "body"]
    best = aggregates.argmax_first(owned(awards), ["url", "center_code", "specialty_code"], "cut", "seq", columns)
    guide = centres.select(F.col("code").alias("center_code"), F.col("name").alias("center_name"), "municipality")
    named = joins.lookup(best.withColumn("municipality", display_place(F.col("locality"))).withColumnRenamed("center_name", "__raw"), guide, ["center_code"], {"center_name": smart_title(F.col("__raw")), "municipality": "municipality"})
    dated = F.coalesce(F.col("published_date").try_cast("date"), F.current_date() if today is None else today.cast("date"))
    return named.drop("__raw", "locality").withColumn("school_year", calendar.school_year(dated))


def assignments(awards: DataFrame) -> DataFrame:
    """Awards of a document, the first of those alike in person, specialty, cut and centre."""
    keyed = owned(awards).withColumn("__p", folded(F.col("candidate_name")))
    keys = ["url", "__p", "specialty_code", "cut", "center_code"]
    others = [c for c in awards.columns if c not in keys]
    return aggregates.distinct_first(keyed, keys, ["seq"], others).select(*awards.columns)


def document_vacancies(awards: DataFrame) -> DataFrame:
    """Per document: records, counted vacancies, excluded ones of the other body, owned ones, and counts by specialty."""
    mine = classify.owner(F.col("specialty_code")) == F.col("body")
    return aggregates.document_summary(awards, "url", "specialty_code", F.col("placement_type") == "vacante", mine)


def _origin(df: DataFrame, origin: str) -> DataFrame:
    return df.withColumn("origin", F.lit(origin))


def apply_start(start: DataFrame, cuts: DataFrame) -> DataFrame:
    """The start's cuts after new documents: the newest document of a body (by date, then url) replaces that body's
    rows; rows of an older school year go."""
    newest = cuts.groupBy("body").agg(F.max(F.struct(F.coalesce("published_date", F.lit("")), "url")).alias("__d")).select(F.col("body").alias("__b"), F.col("__d.url").alias("__u"))
    batch = _origin(cuts, "inicio").join(newest, (F.col("body") == F.col("__b")) & (F.col("url") == F.col("__u")), "left_semi").select(*start.columns)
    current = merge.reset_period(start, batch, "school_year")
    return merge.replace_partitions(current, merge.reset_period(batch, start, "school_year"), "body")


def course_after_start(course: DataFrame, before: DataFrame, start: DataFrame) -> DataFrame:
    """The course's cuts once the start has gone from before to start. A start that opens another year empties the
    course; while the course has no documents of its own in the start's year, it holds the start's rows. A course of
    another year than an unchanged start's stays."""
    year = lambda df, n: df.agg(F.max("school_year").alias(n))  # noqa: E731  one row
    own = course.filter("origin = 'curso'").agg(F.max("school_year").alias("__own"))  # one row
    rule = year(before, "__before").join(year(start, "__now")).join(year(course, "__course")).join(own)
    opened = ~F.col("__now").eqNullSafe(F.col("__before"))
    waiting = F.col("__own").isNull() & F.coalesce(F.col("__course") == F.col("__now"), F.lit(True))
    seeds = F.coalesce(F.col("__now").isNotNull() & (opened | waiting), F.lit(False))
    verdict = F.broadcast(rule.select(seeds.alias("__seeds")))
    seeded = start.join(verdict).filter("__seeds").select(*course.columns)
    return course.join(verdict).filter("not __seeds").select(*course.columns).unionByName(seeded)


def apply_course(course: DataFrame, start: DataFrame, cuts: DataFrame) -> DataFrame:
    """The course's cuts after new documents: the newest row of a centre, specialty and body wins, in the order of
    documents (date, body, url). A new year begins from the start's cuts, as does a course without rows."""
    batch = merge.reset_period(_origin(cuts, "curso").select(*course.columns), course, "school_year")
    current = merge.reset_period(course, batch, "school_year")
    year = merge.union_all(course.select("school_year"), cuts.select("school_year")).agg(F.max("school_year").alias("__y"))  # one row
    seed = start.join(F.broadcast(year), F.col("school_year") == F.col("__y")).select(*course.columns)
    empty = F.broadcast(current.limit(1).agg((F.count("*") == 0).alias("__empty")))  # one row
    seeded = current.unionByName(seed.join(empty).filter("__empty").select(*course.columns))
    return merge.upsert(seeded, batch, KEYS, ["published_date", "url"])


def _decisive(heads: DataFrame, mode: str, today: Column | None) -> DataFrame:
    """url, sha256, body of owned heads that can give rows of the state. At the start of a year an older document of a
    body than one that has its rows cannot be the newest; in the course none of an older school year is of the newest.
    Rows of one document may differ in date: it is out where even its latest comes before another's earliest."""
    owned_heads = heads.filter("owned")
    if mode == "inicio":
        at, over = F.coalesce("published_date", F.lit("")), ["body"]
    else:
        at, over = calendar.school_year(F.coalesce(F.col("published_date").try_cast("date"), F.current_date() if today is None else today.cast("date"))), []
    ranges = owned_heads.groupBy("url", "body").agg(F.min(at).alias("__low"), F.max(at).alias("__high"))
    # A document's rows of another body are rows of it too, so in the course the least counts over all.
    least = ranges.groupBy(*over).agg(F.max("__low").alias("__least"))
    ranges = ranges.join(least, over) if over else ranges.join(F.broadcast(least))  # without bodies one row
    kept = ranges.filter("__high >= __least").select(F.col("url").alias("__u"), F.col("body").alias("__b"))
    return owned_heads.join(kept, F.col("url").eqNullSafe(F.col("__u")) & (F.col("body") == F.col("__b")), "left_semi").select("url", "sha256", "body")


def _of(awards: DataFrame, heads: DataFrame, columns: list[str]) -> DataFrame:
    """Awards that agree with one of the heads, nulls with nulls."""
    named = heads.select(*[F.col(c).alias(f"__h_{c}") for c in columns]).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__h_{c}"))
    return awards.join(named, same, "left_semi")


def run(start: DataFrame, course: DataFrame, ledger: DataFrame, awards: DataFrame, centres: DataFrame, mode: str, today: Column | None = None) -> dict[str, DataFrame]:
    """One update in a mode ('inicio' or 'curso'): documents that the ledger has by url, or by content under another url,
    are left out; the result holds start, course, ledger and vacancies. today (the session's date, if not given) decides
    the school year of documents without a date.

    What the awards say of their documents (heads, a row for each) is written first, then the cuts of those documents
    that can give rows of the state; the ledger needs no more than counts of the others. Awards are read once for each."""
    scratch = Scratch(awards.sparkSession, "cuts")
    mine = F.coalesce(classify.owner(F.col("specialty_code")) == F.col("body"), F.lit(False))
    heads = awards.select("url", "sha256", "body", "published_date", mine.alias("owned")).distinct()
    heads = joins.not_seen_elsewhere(joins.not_seen(heads, ledger, "url"), ledger.filter("sha256 is not null"), "sha256", "url")
    heads = scratch.table(heads, "heads")
    fresh = _of(awards, heads, ["url", "sha256"])
    cuts = scratch.table(document_cuts(_of(awards, _decisive(heads, mode, today), ["url", "sha256", "body"]), centres, today), "cuts")
    if mode == "inicio":
        before, start = start, apply_start(start, cuts)
        course = course_after_start(course, before, start)
    else:
        course = apply_course(course, start, cuts)
    documents = heads.groupBy("url").agg(F.max("sha256").alias("sha256"), F.max("body").alias("body"), F.max("published_date").alias("published_date"))
    rows = owned(fresh).select("url", "center_code", "specialty_code").distinct().groupBy("url").agg(F.count("*").alias("rows"))
    done = documents.join(rows, "url", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return {"start": start, "course": course, "ledger": merge.marked(ledger, done, mode), "vacancies": document_vacancies(fresh)}


def outside_year(url: Column, text: Column, target: Column) -> Column:
    """Whether a link names years, in full or as six digits that begin its file name, none of which is the target's."""
    name = F.element_at(F.split(F.try_url_decode(url), "/"), -1)
    said = F.concat_ws(" ", text, name, F.try_url_decode(url))
    allowed = F.transform(F.split(target, "-"), lambda y: y.cast("int"))
    full = F.transform(F.regexp_extract_all(said, F.lit(r"(?<!\d)(20\d{2})(?!\d)"), F.lit(1)), lambda y: y.cast("int"))
    short = F.regexp_extract(name, r"^(\d{2})\d{4}", 1)
    other = F.when(short != "", ~F.array_contains(allowed, F.lit(2000) + short.try_cast("int"))).otherwise(False)
    return ((F.size(full) > 0) & ~F.arrays_overlap(full, allowed)) | other

"""Awards read from blocks of text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import classify
from .text import folded, squeeze

# Line patterns of award lists.
CANDIDATE = r"^(\d{1,5})(?:\s*/\s*\d{1,5})?\s+(?!\s*/)[^,]+,\s+.+"
RANK = r"^(\d{1,5})(?:\s*/\s*\d{1,5})?\s+"
CENTRE = r"^\d{5,7}\s+(.+)\((\d{8})\)(.+)$"
SPECIALTY = r"^([0-9A-Z]{3})\s*/\s*(.+)$"
MARKERS = r"(?iu)(?:Petici.n\s*:|Voluntaria\b|Obligat.ria\b|PREFER.NCIA\b)"
# The header of a page of other bodies: its marker, lines read after it, a code at a line's end or start.
PAGE_MARKER, PAGE_LINES = "altres cossos / otros cuerpos", 6
CODE_AT_END, CODE_AT_START, DIGIT = r"^(.+?)\s*([0-9A-Z]{3})$", r"^([0-9A-Z]{3})\s+(.+)$", r"\d"


def is_candidate(line: Column) -> Column:
    return line.rlike(CANDIDATE)


def page_specialty(text: Column) -> Column:
    """struct<code,name> of a page: within six lines after the marker, the first line that ends or begins with a code
    of three characters, one a digit at least; lines with a slash don't count. Null without one."""
    lines = F.filter(F.transform(F.split(text, r"\r?\n"), squeeze), lambda x: x != "")
    marked = F.filter(F.transform(lines, lambda x, i: F.when(folded(x).contains(PAGE_MARKER), i)), lambda i: i.isNotNull())
    start = F.get(marked, F.lit(0))
    near = F.slice(lines, start + 2, PAGE_LINES)
    suffix, prefix, digit = CODE_AT_END, CODE_AT_START, DIGIT

    def read(x: Column) -> Column:
        by_end = F.regexp_extract(x, suffix, 2).rlike(digit)
        by_start = F.regexp_extract(x, prefix, 1).rlike(digit)
        code = F.when(by_end, F.regexp_extract(x, suffix, 2)).when(by_start, F.regexp_extract(x, prefix, 1))
        name = F.when(by_end, squeeze(F.regexp_extract(x, suffix, 1))).otherwise(squeeze(F.regexp_extract(x, prefix, 2)))
        return F.when(code.isNotNull(), F.struct(code.alias("code"), name.alias("name")))

    found = F.filter(F.transform(F.filter(near, lambda x: ~x.contains("/")), read), lambda s: s.isNotNull())
    return F.when(start.isNotNull(), F.get(found, F.lit(0)))


def awards(blocks: DataFrame) -> DataFrame:
    """blocks: lines array<string>, body, page_specialty struct<code,name> (nullable), and any other columns, which
    stay. Adds award, null where the block is no award."""
    head = F.get("lines", F.lit(0))
    rest = F.slice("lines", F.lit(2), F.greatest(F.size("lines"), F.lit(1)))
    first = lambda p: F.get(F.filter(rest, lambda x: x.rlike(p)), F.lit(0))
    # Columns of their own, so that lines are searched, and the text is folded, once for all that is read from them.
    found = blocks.withColumns({"__centre": first(CENTRE), "__spec": first(SPECIALTY), "__text": folded(F.array_join("lines", " "))})
    centre, spec, joined = F.col("__centre"), F.col("__spec"), F.col("__text")
    awarded = F.regexp_extract(spec, SPECIALTY, 1)
    other = F.col("body") == "secundaria"
    code = F.when(other, F.col("page_specialty.code")).otherwise(awarded)
    name = F.when(other, F.col("page_specialty.name")).otherwise(squeeze(F.regexp_extract(spec, SPECIALTY, 2)))
    valid = F.exists("lines", lambda x: x.contains("Adjudicat")) & head.rlike(RANK) & centre.isNotNull() & spec.isNotNull() & (~other | (F.col("page_specialty.code") == awarded))
    candidate = squeeze(F.get(F.split(F.regexp_replace(head, RANK, ""), MARKERS, 2), F.lit(0)))
    award = F.struct(
        F.regexp_extract(head, RANK, 1).try_cast("int").alias("cut"),
        candidate.alias("candidate_name"),
        F.regexp_extract(centre, CENTRE, 2).alias("center_code"),
        code.alias("specialty_code"),
        name.alias("specialty_name"),
        squeeze(F.regexp_extract(centre, CENTRE, 3)).alias("center_name"),
        squeeze(F.regexp_extract(centre, CENTRE, 1)).alias("locality"),
        F.col("body"),
        classify.placement(joined).alias("placement_type"),
        classify.english_required(joined, F.col("body")).alias("english_requirement"),
        classify.workload(joined).alias("workload"),
        classify.itinerant(joined).alias("itinerant"),
    )
    return found.withColumn("award", F.when(valid, award)).drop("__centre", "__spec", "__text")

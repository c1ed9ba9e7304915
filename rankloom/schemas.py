"""Schemas of the placement data, and upgrades of older row forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CENTRES = "code string, name string, type_es string, type_va string, regime string, address string, postcode string, phone string, email string, web string, web_va string, municipality string, district string, province string, lat double, lon double"
CUTS = "center_code string, specialty_code string, cut int, specialty_name string, center_name string, municipality string, body string, placement_type string, origin string, english_requirement boolean, itinerant boolean, specialty_position int"
AWARDS = "cut int, candidate_name string, center_code string, specialty_code string, specialty_name string, center_name string, locality string, body string, placement_type string, english_requirement boolean, workload string, itinerant boolean"
ASSIGNMENTS = "body string, specialty_code string, person_index int, position_index int, after_order int, initial_order int, center_code string, province_index int, published_date string, mode string, placement_type string, candidate_name string, source_url string, source_sha256 string, workload string, english_requirement boolean, itinerant boolean, center_name string, locality string"
POSITIONS = "specialty_code string, at_start int, without_deactivated int, after int, after_without int, reference string, english_position int, context array<int>, status string, detail struct<stage:string,date:string,placement_type:string,workload:string,center_code:string,english_requirement:boolean,itinerant:boolean,center_name:string,municipality:string>"
OFFERS = "offer_order int, body string, specialty_code string, province string, municipality string, center_code string, center_name string, slot_id string, hours double, english_requirement boolean, itinerant boolean, observations string, placement_type string"
ACCREDITATIONS = "official_name string, display_name string, highest_level string, levels array<string>, provinces array<string>, first_date string, latest_date string"


def names_of(schema: str) -> list[str]:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).fieldNames()


def field(row: Column, header: list[str], name: str) -> Column:
    """A positional row's value by header name; null where the row is short or the header lacks it."""
    return F.try_element_at(row, F.lit(header.index(name) + 1)) if name in header else F.lit(None).cast("string")


def positional(df: DataFrame, row: str, header: list[str], schema: str, keep: list[str] | None = None) -> DataFrame:
    """array<string> rows to typed columns by header, after the columns to keep; values that don't parse are null."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    return df.select(*(keep or []), *[field(F.col(row), header, f.name).try_cast(f.dataType).alias(f.name) for f in fields])


def keyed(df: DataFrame, row: str, schema: str) -> DataFrame:
    """map<string,string> rows (the form with names in each row) to the same typed columns."""
    from pyspark.sql.types import StructType

    return df.select(*[F.try_element_at(row, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields])


def upgraded_cuts(df: DataFrame, row: str, origin: Column) -> DataFrame:
    """Cut rows of 7 to 12 fields (array<string>) to the current twelve. The oldest form has its origin at the eighth
    place, stored rows at the ninth; freshly parsed rows have flags from the ninth place on and take the given origin."""
    r = F.col(row)
    at = lambda i: F.get(r, F.lit(i))
    is_origin = lambda i: F.coalesce(at(i).isin("inicio", "curso"), F.lit(False))
    oldest, stored = is_origin(7), is_origin(8)
    flags = F.when(oldest | stored, F.slice(r, F.when(oldest, 9).otherwise(10), 12)).otherwise(F.slice(r, 9, 12))
    flag = lambda i: F.coalesce(F.get(flags, F.lit(i)).try_cast("boolean"), F.lit(False))
    return df.select(
        *[at(i).alias(n) for i, n in enumerate(("center_code", "specialty_code"))],
        at(2).try_cast("int").alias("cut"),
        *[at(i).alias(n) for i, n in ((3, "specialty_name"), (4, "center_name"), (5, "municipality"), (6, "body"))],
        F.when(oldest, "").otherwise(F.coalesce(at(7), F.lit(""))).alias("placement_type"),
        F.when(oldest, at(7)).when(stored, at(8)).otherwise(origin).alias("origin"),
        flag(0).alias("english_requirement"),
        flag(1).alias("itinerant"),
        F.get(flags, F.lit(2)).try_cast("int").alias("specialty_position"),
    )

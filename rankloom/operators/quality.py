"""Declared data-quality rules: a table of violations, counts, and a gate that stops a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import finite


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """rule, key for every row and rule that does not hold (null counts as not holding); one pass."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.select(F.explode(broken).alias("rule"), F.col(key).alias("key"))


def report(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row for every rule, with its number of violations."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{i}") for i, ok in enumerate(rules.values())])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(rules)])).alias("x")).select("x.*")


def observed(df: DataFrame, rules: dict[str, Column], name: str = "quality"):
    """df, and an observation that holds the number of violations of each rule once df has been run; no pass of its own."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()]), seen


def write_report(df: DataFrame, key: str, rules: dict[str, Column], path: str, examples: int = 50) -> bool:
    """Writes counts and the first violations of all rules, by rule and key, as JSON; whether there are none. The bound
    is on what is shown, the counts are of all rows."""
    from ..sources.tables import write_json_atomically

    counts = {r["rule"]: r["violations"] for r in report(df, key, rules).collect()}  # one row for each rule
    shown = [{"rule": r["rule"], "key": str(r["key"])} for r in violations(df, key, rules).orderBy("rule", "key").limit(examples).collect()]
    write_json_atomically(path, {"violations": counts, "errors": shown})
    return not any(counts.values())


def gated(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df, which fails when run if a row breaks a rule; the first broken rule names the error."""
    message = F.lit(None).cast("string")
    for name, ok in reversed(rules.items()):
        message = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(message)
    return df.withColumn("__m", message).filter(F.when(F.col("__m").isNotNull(), F.raise_error(F.concat(F.lit("rule broken: "), "__m")).cast("boolean")).otherwise(True)).drop("__m")


def least_rows(df: DataFrame, n: int, what: str) -> DataFrame:
    """One row, true, or an error if the table has fewer rows."""
    return df.agg(F.count("*").alias("n")).select(F.when(F.col("n") >= n, True).otherwise(F.raise_error(F.concat(F.lit(f"{what}: fewer than {n} rows: "), F.col("n").cast("string"))).cast("boolean")).alias("ok"))


def rank_rules(start: str, without: str, after: str, after_without: str) -> dict[str, Column]:
    """Invariants of positions on a list."""
    c = F.col
    return {
        "without_positive": c(without).isNull() | (c(without) >= 1),
        "after_positive": c(after).isNull() | (c(after) >= 1),
        "after_without_not_above_after": c(after_without).isNull() | c(after).isNull() | (c(after_without) <= c(after)),
        "without_follows_after": c(after).isNull() | c(without).eqNullSafe(c(after_without)),
        "no_after_without_alone": c(after).isNotNull() | c(after_without).isNull(),
    }


# Names and forms of published offers, cut tables and override files.
OFFER_DATASET, OFFER_MODE, OFFER_STATUS = "puestos_ofertados", "replace_latest_snapshot", "published"
PLACEMENTS = ("vacante", "sub_indeterminada", "sub_determinada")
CUT_FIELDS = ("codigoEspecialidad", "numeroCorte", "cuerpo", "tipoPlaza")
LEAST_CUT_SCHEMA, LEAST_CUT_POLICY, WEB_SCHEMA = 3, 5, 1
CODE = r"^\d{8}$"


def offer_rules() -> dict[str, Column]:
    """Rules of rows of offered positions."""
    return {
        "order_present": F.col("offer_order").isNotNull() & (F.col("offer_order") > 0),
        "centre_code": F.coalesce(F.col("center_code"), F.lit("")).rlike(CODE),
        "placement": F.col("placement_type").isin(*PLACEMENTS),
    }


def offer_payload_rules(target_year: Column, fields: list[str]) -> dict[str, Column]:
    """Rules of a payload: dataset, update_mode, academic_year, status, publication_date, item_fields array<string>,
    items array<array<string>> (order first, centre code sixth, placement thirteenth)."""
    c, names = F.col, F.array(*map(F.lit, fields))
    every = lambda test: F.forall("items", test)
    orders = F.transform("items", lambda x: F.get(x, F.lit(0)))
    return {
        "dataset": (c("dataset") == OFFER_DATASET) & (c("update_mode") == OFFER_MODE),
        "year": c("academic_year") == target_year,
        "status": c("status") == OFFER_STATUS,
        "date": c("publication_date").try_cast("date").isNotNull(),
        "fields": c("item_fields") == names,
        "items": F.size("items") > 0,
        "whole_items": every(lambda x: F.size(x) == len(fields)),
        "distinct_orders": F.size(F.array_distinct(orders)) == F.size(orders),
        "centre_codes": every(lambda x: F.coalesce(F.get(x, F.lit(5)), F.lit("")).rlike(CODE)),
        "placements": every(lambda x: F.coalesce(F.get(x, F.lit(12)), F.lit("")).isin(*PLACEMENTS)),
    }


def offer_snapshot_violations(heads: DataFrame, items: DataFrame, target_year: Column, fields: list[str]) -> DataFrame:
    """rule, key (sha256) of snapshots that break the rules of offer_payload_rules, with items as rows, so that no row
    holds a snapshot. heads: sha256, dataset, update_mode, academic_year, status, publication_date, item_fields. items:
    sha256, item (array<string>). Items are counted in each task before they meet their head."""
    empty = heads.withColumn("items", F.array(F.array(F.lit(""))))
    of_items = ("items", "whole_items", "distinct_orders", "centre_codes", "placements")
    plain = {n: ok for n, ok in offer_payload_rules(target_year, fields).items() if n not in of_items}
    bad = lambda test: F.count_if(~F.coalesce(test, F.lit(False)))
    cell = lambda i: F.coalesce(F.get("item", F.lit(i)), F.lit(""))
    # Orders are counted apart; a null order counts as one of its own, as in an array.
    orders = items.groupBy("sha256", F.get("item", F.lit(0)).alias("o")).agg(F.count("*").alias("n")).groupBy("sha256").agg(F.max("n").alias("most"))
    counted = items.groupBy("sha256").agg(F.count("*").alias("n"), bad(F.size("item") == len(fields)).alias("short"), bad(cell(5).rlike(CODE)).alias("codes"), bad(cell(12).isin(*PLACEMENTS)).alias("kinds")).join(orders, "sha256")
    joined = empty.join(counted.select("sha256", *[F.col(c).alias(f"__{c}") for c in ("n", "short", "most", "codes", "kinds")]), "sha256", "left")
    none = F.col("__n").isNull()
    return violations(joined, "sha256", plain | {"items": ~none, "whole_items": none | (F.col("__short") == 0), "distinct_orders": none | (F.col("__most") == 1), "centre_codes": none | (F.col("__codes") == 0), "placements": none | (F.col("__kinds") == 0)})


def document_rules(items: DataFrame, document: str, order: str, date: str) -> DataFrame:
    """rule, key for documents with an order number given twice or without a date. Documents without items have no row
    here; see documents_without."""
    per = items.groupBy(document).agg(F.count(order).alias("__n"), F.count_distinct(order).alias("__d"), F.max(date).alias("__t"))
    return violations(per, document, {"distinct_orders": F.col("__n") == F.col("__d"), "date": F.col("__t").isNotNull()})


def documents_without(documents: DataFrame, items: DataFrame, document: str) -> DataFrame:
    """rule, key for documents that gave no item."""
    return documents.join(items.select(document), document, "left_anti").select(F.lit("items").alias("rule"), F.col(document).alias("key"))


def repeated_keys(df: DataFrame, key: str, rule: str = "key_once") -> DataFrame:
    """rule, key for keys that are null, blank or in several rows."""
    g = df.groupBy(F.trim(F.col(key).cast("string")).alias("key")).agg(F.count("*").alias("__n"))
    return g.filter("key is null or key = '' or __n > 1").select(F.lit(rule).alias("rule"), "key")


def override_rules(row: str, fields: int, lat: int = 14, lon: int = 15) -> dict[str, Column]:
    """Rules of a centre override, an array<string>; keys have a rule of their own (repeated_keys)."""
    number = lambda i: finite(F.get(row, F.lit(i)).try_cast("double"))
    return {"arity": F.size(row) == fields, "coordinates": number(lat) & number(lon)}


def web_override_violations(websites: DataFrame, blocked: DataFrame) -> DataFrame:
    """rule, key. websites: code, url; blocked: code, reason."""
    url = F.trim("url")
    site = {"code": F.col("code").rlike(CODE), "url": F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & (F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")) != "")}
    block = {"code": F.col("code").rlike(CODE), "reason": F.trim("reason") != ""}
    both = websites.join(blocked.select("code"), "code", "left_semi").select(F.lit("mapped_and_blocked").alias("rule"), F.col("code").alias("key"))
    return violations(websites, "code", site).unionByName(violations(blocked, "code", block)).unionByName(both)


def cut_table_rules(hashes: dict[str, str]) -> dict[str, Column]:
    """Preconditions of a cut table for the last awarded: schema_version, policy_version, cut_format array<string>, and
    pdfs, a map of body to the sha256 that positions were made from."""
    same = {f"pdf_{body}": F.coalesce(F.try_element_at("pdfs", F.lit(body)), F.lit("")) == digest for body, digest in hashes.items()}
    needed = F.array(*map(F.lit, CUT_FIELDS))
    return {"schema": F.col("schema_version") >= LEAST_CUT_SCHEMA, "policy": F.col("policy_version") >= LEAST_CUT_POLICY, **same, "fields": F.size(F.array_except(needed, "cut_format")) == 0}


def control_examples(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """rule, key for expected rows that no found row equals in all columns of expected; nulls equal nulls."""
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}")) for c in expected.columns]
    test = same[0]
    for x in same[1:]:
        test = test & x
    return expected.alias("e").join(found.alias("f"), test, "left_anti").select(F.lit("control_example").alias("rule"), F.col(key).alias("key"))


def is_pdf(content: Column) -> Column:
    """Bytes that begin, after white space, with a PDF's mark."""
    return F.coalesce(F.decode(F.substring(content, 1, 1024), "ISO-8859-1").rlike(r"^[\x09-\x0D\x20]*%PDF-"), F.lit(False))


def unambiguous(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys and value, one row for each key; fails when run if a key has several values."""
    g = df.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("__high"))
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    broken = F.raise_error(F.concat(F.lit("ambiguous: "), name)).cast("boolean")
    return g.filter(F.when(F.col(value).eqNullSafe(F.col("__high")), True).otherwise(broken)).select(*keys, value)

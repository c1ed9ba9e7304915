"""Catalogue entries of pipelines, gates, sources and text rules. Where the tables have no text of the kind, lines are
composed from their columns, so that SQL can say from the columns what reading the lines must give."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import blocks, classify, ranks, text
from ..operators import aggregates, joins, merge, quality, windows
from ..pipelines import accreditations, cuts, offers, positions
from ..schemas import OFFERS, names_of
from ..sources import centres, html, lines
from .catalogue import _t, entry

# Merges and ledgers


@entry("""
SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def full_row_override(spark, sf_dir):
    """Customers of one segment override suppliers of their key as whole rows, and are added where there is none."""
    base = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    new = _t(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    return joins.override_rows(base, new, "k")


@entry("SELECT s_suppkey AS k FROM supplier UNION SELECT o_custkey FROM orders")
def key_union(spark, sf_dir):
    return merge.key_union(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@entry("SELECT c_custkey AS k, c_name AS name, NULL AS phone FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def union_of_lists(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return merge.union_all(c, _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("phone")))


@entry("""
SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT o_orderkey, 'order ' || o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)
""")
def seeded_state(spark, sf_dir):
    state = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return merge.seeded(state, _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("order "), "o_orderkey").alias("name")), ["k"])


@entry("SELECT o_orderkey, coalesce(year(o_orderdate) = 1998, false) AS accepted FROM orders")
def period_rejection(spark, sf_dir):
    """Rows of the wanted year, and the rejected rest."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    own, rest = merge.of_period(o, F.year("o_orderdate"), 1998)
    return own.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(rest.select("o_orderkey", F.lit(False).alias("accepted")))


@entry("""
SELECT o_orderkey, o_orderstatus IS DISTINCT FROM left(o_orderpriority, 1) AND (o_custkey % 3 <> 0 OR o_totalprice < 100000 OR o_orderdate >= TIMESTAMP '1998-01-01') AS publish FROM orders
""")
def publish_decision(spark, sf_dir):
    """Whether an order would replace an older state: other content, and not older within the same year."""
    old_date = F.when(F.col("o_totalprice") >= 100000, F.to_timestamp(F.lit("1998-01-01")))
    rule = merge.should_publish(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"), old_date, F.col("o_orderdate"), F.lit(0), (F.col("o_custkey") % 3).cast("int"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", rule.alias("publish"))


@entry("""
WITH d AS (SELECT c_name AS url, c_mktsegment AS reason, c_acctbal FROM customer)
SELECT url, CASE WHEN c_acctbal > 0 THEN 'curso' ELSE 'curso:ignored' END AS mode, CASE WHEN c_acctbal > 0 THEN NULL ELSE reason END AS reason, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS n FROM d
""")
def ledger_marks(spark, sf_dir):
    """Documents processed or ignored with a reason; marks of an earlier run are replaced."""
    d = _t(spark, sf_dir, "customer").select(F.col("c_name").alias("url"), F.sha2("c_name", 256).alias("sha256"), F.lit("m").alias("body"), F.lit(None).cast("string").alias("published_date"), F.lit(1).alias("rows"), "c_mktsegment", "c_acctbal")
    before = merge.marked(spark.createDataFrame([], merge.LEDGER), d, "inicio")
    seen = merge.marked(before, d.filter("c_acctbal > 0"), "curso")
    return merge.ignored(seen, d.filter("not c_acctbal > 0"), "curso", F.col("c_mktsegment")).select("url", "mode", "reason", F.col("rows").cast("int").alias("n"))


@entry("""
WITH h AS (SELECT date_trunc('day', ts) AS day, event_type, hour(ts) AS h FROM events), n AS (SELECT event_type, h, day, count(*) AS n FROM h GROUP BY ALL)
SELECT event_type || ':' || h AS key, arg_max(n, day) AS n FROM n GROUP BY event_type, h
""")
def reason_counts(spark, sf_dir):
    """Counts by type and hour; the newest day that has any overwrites earlier ones."""
    ev = _t(spark, sf_dir, "events").select("event_type", F.hour(F.col("ts").cast("timestamp")).alias("h"), F.to_date("ts").alias("day"))
    return aggregates.reason_counts(ev, ["event_type"], "h", "day")


@entry("SELECT o_orderkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def fingerprint_gate(spark, sf_dir):
    """A rebuilt table that is taken because the digest of one of its sources is another."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    prints = lambda df: df.groupBy(F.col("y").cast("string").alias("name")).agg(F.concat_ws(":", F.count("*"), F.sum("o_orderkey")).alias("sha256"))
    newest = o.agg(F.max("y").alias("m"))
    rebuilt = o.join(F.broadcast(newest), F.col("y") == F.col("m")).select("o_orderkey")
    return merge.rebuilt_if_changed(o.select("o_orderkey"), rebuilt, prints(o.filter("o_orderkey <> 0")), prints(o))


# Aggregates, ranks, order


@entry("""
WITH x AS (SELECT l_suppkey, l_returnflag AS f, l_linestatus = 'F' AS c, l_returnflag IN ('A', 'R') AS o FROM lineitem),
p AS (SELECT l_suppkey, f, count(*) FILTER (WHERE c AND o) AS n FROM x GROUP BY ALL)
SELECT l_suppkey, count(*) AS records, count(*) FILTER (WHERE c) AS counted, count(*) FILTER (WHERE c AND NOT o) AS excluded, count(*) FILTER (WHERE c AND o) AS owned,
       (SELECT coalesce(string_agg(f || '=' || n, ',' ORDER BY f), '') FROM p WHERE p.l_suppkey = x.l_suppkey AND n > 0) AS counts FROM x GROUP BY l_suppkey
""")
def document_summary(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    s = aggregates.document_summary(li, "l_suppkey", "l_returnflag", F.col("l_linestatus") == "F", F.col("l_returnflag").isin("A", "R"))
    return s.withColumn("counts", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


@entry("SELECT l_suppkey, sum((l_returnflag = 'R')::INT + (l_discount > 0.05)::INT)::BIGINT AS total FROM lineitem GROUP BY 1")
def occupancy_totals(spark, sf_dir):
    return aggregates.occupancy(_t(spark, sf_dir, "lineitem"), "l_suppkey", (F.col("l_returnflag") == "R").cast("int") + (F.col("l_discount") > 0.05).cast("int"))


@entry("""
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_linenumber, 1), l_quantity::INT) AS rank, CASE WHEN l_returnflag = 'R' THEN l_linestatus = 'F' ELSE l_tax > 0.04 END AS disabled FROM lineitem
""")
def rank_choices(spark, sf_dir):
    """The rank after the awards or the initial one; the award list's flag or the list's own mark."""
    rank = ranks.compatible_rank(F.nullif(F.col("l_linenumber"), F.lit(1)), F.col("l_quantity").cast("int"))
    flag = ranks.effective_disabled(F.col("l_returnflag") == "R", F.col("l_linestatus") == "F", F.col("l_tax") > 0.04)
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rank.alias("rank"), flag.alias("disabled"))


@entry("""
SELECT event_id, CASE WHEN length(d) >= 6 THEN right(d, 6) END AS slot, CASE WHEN value >= 1 AND value = floor(value) THEN value::INT END AS whole
FROM (SELECT *, regexp_replace(props || event_id || user_id, '[^0-9]+', '', 'g') AS d FROM events)
""")
def last_digits(spark, sf_dir):
    whole = ranks.positive_integer(F.when(F.col("value") == F.floor("value"), F.col("value").cast("long")))
    return _t(spark, sf_dir, "events").select("event_id", ranks.last_digits(F.concat("props", F.col("event_id").cast("string"), F.col("user_id").cast("string"))).alias("slot"), whole.alias("whole"))


@entry("SELECT c_custkey, row_number() OVER (ORDER BY lower(c_mktsegment), c_custkey) AS place FROM customer")
def name_order(spark, sf_dir):
    """Places by display name; equal names keep their order."""
    return windows.name_order(_t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey").select("c_custkey", "place")


_ENGLISH = """
WITH p AS (SELECT o_custkey AS person_index, ['120', '121', '123', '124', '126', '127', '128', '153'][o_orderkey % 8 + 1] AS specialty_code, o_orderkey AS after, c_acctbal > 5000 AS acc, c_mktsegment <> 'MACHINERY' AS masters
           FROM orders JOIN customer ON o_custkey = c_custkey),
h AS (SELECT person_index, bool_or(specialty_code = '121') AS has FROM p GROUP BY 1),
x AS (SELECT *, CASE WHEN masters AND specialty_code <> '121' THEN has::INT + acc::INT ELSE 0 END AS n FROM p JOIN h USING (person_index)),
s AS (SELECT *, sum(n) OVER (PARTITION BY specialty_code ORDER BY after, person_index)::BIGINT AS s FROM x)
"""


def _positions(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal", "c_mktsegment")
    code = F.element_at(F.array(*map(F.lit, ("120", "121", "123", "124", "126", "127", "128", "153"))), (F.col("o_orderkey") % 8 + 1).cast("int"))
    rows = _t(spark, sf_dir, "orders").join(c, "o_custkey")
    return rows.select(F.col("o_custkey").alias("person_index"), F.col("c_name").alias("official_name"), code.alias("specialty_code"), F.col("o_orderkey").alias("after"), (F.col("c_mktsegment") != "MACHINERY").alias("masters"))


@entry(_ENGLISH + "SELECT person_index, after, CASE WHEN n > 0 THEN s END AS english_position FROM s")
def english_positions(spark, sf_dir):
    """Ranks among credentials, on the lists that count them."""
    named = _t(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.col("c_name").alias("official_name"))
    return positions.english_positions(_positions(spark, sf_dir), named).select("person_index", "after", F.col("english_position").cast("long").alias("english_position"))


@entry(_ENGLISH + "SELECT person_index, after, CASE WHEN n > 0 THEN s END AS english_position FROM s")
def accreditation_cascade(spark, sf_dir):
    """Accreditations are merged in, then the ranks that follow from them are worked out anew."""
    records = _t(spark, sf_dir, "customer").filter("c_acctbal > 5000").select(F.col("c_name").alias("official_name"), F.lit("B2").alias("level"), F.lit("Alicante").alias("province"), F.lit("u").alias("source_url"), F.lit("2026-01-01").alias("date"))
    out = accreditations.run(spark.createDataFrame([], accreditations.STATE), records, _positions(spark, sf_dir))
    return out["positions"].select("person_index", "after", F.col("english_position").cast("long").alias("english_position"))


@entry("""
WITH p AS (SELECT c_custkey AS profile, c_name AS name, c_mktsegment AS code, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 50 END AS after FROM customer),
a AS (SELECT o_orderkey AS id, c_name AS name, c_mktsegment AS code, o_orderkey % 50 AS cut FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT code, after AS cut, min(profile) AS profile FROM p WHERE after IS NOT NULL GROUP BY ALL HAVING count(*) = 1)
SELECT id, CASE WHEN after = a.cut THEN p.profile WHEN r.profile IS NOT NULL THEN r.profile ELSE p.profile END AS profile, CASE WHEN after = a.cut THEN 'exact' WHEN r.profile IS NOT NULL THEN 'ranked' ELSE 'unranked' END AS tier
FROM a JOIN p USING (name, code) LEFT JOIN r ON r.code = a.code AND r.cut = a.cut WHERE after = a.cut OR r.profile IS NOT NULL OR after IS NULL
""")
def profile_resolution(spark, sf_dir):
    """Profiles that assignments at the start of a year can mean."""
    c = _t(spark, sf_dir, "customer")
    p = c.select(F.col("c_custkey").alias("profile"), F.col("c_name").alias("official_name"), F.col("c_mktsegment").alias("specialty_code"), F.lit("m").alias("body"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_custkey") % 50).alias("after_order"))
    o = _t(spark, sf_dir, "orders").join(c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"), "o_custkey")
    a = o.select(F.col("o_orderkey").alias("id"), F.col("c_name").alias("candidate_name"), F.col("c_mktsegment").alias("specialty_code"), F.lit("m").alias("body"), (F.col("o_orderkey") % 50).alias("cut"))
    none = spark.createDataFrame([], "profile bigint, candidate_name string, specialty_code string")
    return positions.resolve_profiles(a, p, none, "inicio")


# Gates


@entry("""
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS key, nullif(l_linenumber - 1, 3) AS w, nullif(l_quantity::INT - 1, 10) AS a, nullif(l_linenumber % 5, 2) AS aw FROM lineitem)
SELECT 'without_positive' AS rule, key FROM r WHERE w < 1 UNION ALL SELECT 'after_positive', key FROM r WHERE a < 1 UNION ALL SELECT 'after_without_not_above_after', key FROM r WHERE aw > a
UNION ALL SELECT 'without_follows_after', key FROM r WHERE a IS NOT NULL AND w IS DISTINCT FROM aw UNION ALL SELECT 'no_after_without_alone', key FROM r WHERE a IS NULL AND aw IS NOT NULL
""")
def rank_gate(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.lit(1).alias("s"), F.nullif(F.col("l_linenumber") - 1, F.lit(3)).alias("w"), F.nullif(F.col("l_quantity").cast("int") - 1, F.lit(10)).alias("a"), F.nullif(F.col("l_linenumber") % 5, F.lit(2)).alias("aw")
    )
    return quality.violations(li, "key", quality.rank_rules("s", "w", "a", "aw"))


@entry("""
WITH r AS (SELECT o_orderkey, o_custkey % 40 - 1 AS n, CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE lpad(o_custkey::VARCHAR, 8, '0') END AS c, CASE o_orderstatus WHEN 'F' THEN 'vacante' WHEN 'O' THEN 'sub_determinada' ELSE 'other' END AS p FROM orders)
SELECT 'order_present' AS rule, o_orderkey AS key FROM r WHERE n <= 0 UNION ALL SELECT 'centre_code', o_orderkey FROM r WHERE c = 'x' UNION ALL SELECT 'placement', o_orderkey FROM r WHERE p = 'other'
""")
def offer_gate(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 40 - 1).alias("offer_order"), F.when(F.col("o_orderkey") % 9 == 0, "x").otherwise(F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("center_code"),
        classify.first_of([(F.col("o_orderstatus") == "F", "vacante"), (F.col("o_orderstatus") == "O", "sub_determinada")], "other").alias("placement_type"),
    )
    return quality.violations(o, "o_orderkey", quality.offer_rules())


@entry("""
SELECT 'distinct_orders' AS rule, l_suppkey::VARCHAR AS key FROM lineitem GROUP BY l_suppkey HAVING count(l_orderkey) <> count(DISTINCT l_orderkey)
UNION ALL SELECT 'items', c_custkey::VARCHAR FROM customer WHERE c_custkey NOT IN (SELECT l_suppkey FROM lineitem)
UNION ALL SELECT 'key_once', c_nationkey::VARCHAR FROM customer GROUP BY c_nationkey HAVING count(*) > 1
""")
def document_gate(spark, sf_dir):
    """Documents with an order number given twice, documents without rows, keys given twice."""
    li = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("d"), "l_orderkey", "l_shipdate")
    text_key = lambda df: df.select("rule", F.col("key").cast("string").alias("key"))
    none = quality.documents_without(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("d")), li, "d")
    return text_key(quality.document_rules(li, "d", "l_orderkey", "l_shipdate")).unionByName(text_key(none)).unionByName(quality.repeated_keys(_t(spark, sf_dir, "customer"), "c_nationkey"))


@entry("""
WITH w AS (SELECT lpad(c_custkey::VARCHAR, CASE WHEN c_custkey % 7 = 0 THEN 7 ELSE 8 END, '0') AS code, c_custkey AS k FROM customer), b AS (SELECT lpad(s_suppkey::VARCHAR, 8, '0') AS code, s_suppkey AS k FROM supplier)
SELECT 'code' AS rule, code AS key FROM w WHERE k % 7 = 0 UNION ALL SELECT 'url', code FROM w WHERE k % 5 = 0 UNION ALL SELECT 'reason', code FROM b WHERE k % 3 = 0 UNION ALL SELECT 'mapped_and_blocked', code FROM w WHERE code IN (SELECT code FROM b)
""")
def web_override_gate(spark, sf_dir):
    k = F.col("c_custkey")
    code = F.when(k % 7 == 0, F.lpad(k.cast("string"), 7, "0")).otherwise(F.lpad(k.cast("string"), 8, "0"))
    url = F.when(k % 10 == 0, "ftp://example.org/").when(k % 5 == 0, "http:///nothing").otherwise("https://example.org/x")
    sites = _t(spark, sf_dir, "customer").select(code.alias("code"), url.alias("url"))
    reason = F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise("closed")
    return quality.web_override_violations(sites, _t(spark, sf_dir, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("code"), reason.alias("reason")))


# Texts and sources


@entry("""
SELECT o_orderkey, (o_orderkey % 90000 + 1)::INT AS cut, 'PERSON ' || o_custkey || ', ANA' AS candidate_name, lpad(o_custkey::VARCHAR, 8, '0') AS center_code, CASE WHEN o_orderstatus = 'F' THEN '126' ELSE '3A1' END AS specialty_code,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'vacante' WHEN '2-HIGH' THEN 'sub_determinada' WHEN '3-MEDIUM' THEN 'sub_indeterminada' ELSE '' END AS placement_type,
       CASE WHEN o_custkey % 2 = 0 THEN (o_custkey % 30)::VARCHAR ELSE 'C' END AS workload, o_custkey % 5 = 0 AS itinerant, o_custkey % 3 = 0 AS english_requirement FROM orders
""")
def award_blocks(spark, sf_dir):
    """Awards read from blocks of lines."""
    c = F.col
    kind = classify.lookup({"1-URGENT": "VACANT", "2-HIGH": "Substitució determinada", "3-MEDIUM": "SUSTITUCIÓN INDETERMINADA"}, c("o_orderpriority"))
    rows = F.array(
        F.concat((c("o_orderkey") % 90000 + 1).cast("string"), F.lit(" / 7 PERSON "), c("o_custkey"), F.lit(", ANA Petición : 3")),
        F.concat(F.lit("921979 TOWN("), F.lpad(c("o_custkey").cast("string"), 8, "0"), F.lit(")SCHOOL")),
        F.concat(F.when(c("o_orderstatus") == "F", "126").otherwise("3A1"), F.lit(" / NAME")),
        F.concat_ws(" ", F.lit("Adjudicat"), kind, F.when(c("o_custkey") % 2 == 0, F.concat((c("o_custkey") % 30).cast("string"), F.lit(" hores"))), F.when(c("o_custkey") % 5 == 0, "Itinerante"), F.when(c("o_custkey") % 3 == 0, "/ ING.")),
    )
    made = _t(spark, sf_dir, "orders").select("o_orderkey", rows.alias("lines"), F.lit("maestros").alias("body"), F.lit(None).cast("struct<code:string,name:string>").alias("page_specialty"))
    return blocks.awards(made).select("o_orderkey", *[f"award.{x}" for x in ("cut", "candidate_name", "center_code", "specialty_code", "placement_type", "workload", "itinerant", "english_requirement")])


@entry("SELECT p_partkey, '2A' || p_size % 10 AS code, upper(p_name) AS name FROM part")
def page_headers(spark, sf_dir):
    """The specialty in a page's header, before or after its name."""
    code, name = F.concat(F.lit("2A"), (F.col("p_size") % 10).cast("string")), F.upper("p_name")
    line = F.when(F.col("p_size") % 2 == 0, F.concat(code, F.lit(" "), name)).otherwise(F.concat(name, code))
    page = F.concat(F.lit("head\n Altres  Cossos / Otros Cuerpos\na / b\n"), line, F.lit("\nrest"))
    return _t(spark, sf_dir, "part").select("p_partkey", blocks.page_specialty(page).alias("h")).select("p_partkey", "h.code", "h.name")


@entry("""
SELECT p_partkey, 'IES la '[:4] || 'La ' || array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') || ' d''en Joan XII' AS title,
       'La ' || array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS place, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') || ' ' || p_type[1] || lower(p_type[2:]) AS person
FROM part
""")
def display_names(spark, sf_dir):
    """Names of centres, places and persons as they are shown."""
    n = F.upper("p_name")
    return _t(spark, sf_dir, "part").select(
        "p_partkey", text.smart_title(F.concat(F.lit("IES LA "), n, F.lit(" D'EN JOAN XII"))).alias("title"), text.display_place(F.concat(n, F.lit("  (LA)"))).alias("place"), text.display_name(F.concat("p_type", F.lit(", "), n)).alias("person")
    )


@entry("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'D' WHEN '2-HIGH' THEN 'N' WHEN '3-MEDIUM' THEN 'P' WHEN '4-NOT SPECIFIED' THEN 'A' END AS status,
       CASE o_orderstatus WHEN 'F' THEN 'maestros' WHEN 'O' THEN 'secundaria' END AS body, CASE WHEN o_custkey % 2 = 0 THEN 'IES' ELSE '' END AS kind FROM orders
""")
def line_classes(spark, sf_dir):
    """Status, body and kind of centre, read from lines."""
    c = F.col
    said = F.coalesce(classify.lookup({"1-URGENT": "DESACTIVADA", "2-HIGH": "No ha  participat hui", "3-MEDIUM": "Ha participado", "4-NOT SPECIFIED": "Adjudicat"}, c("o_orderpriority")), F.lit("adjudicatx"))
    head = F.coalesce(classify.lookup({"F": "x Mestres / Maestros", "O": "Altres Cossos /  Otros cuerpos"}, c("o_orderstatus")), F.lit("Cuerpos"))
    kind = F.when(c("o_custkey") % 2 == 0, "INSTITUTO DE EDUCACIÓN SECUNDARIA").otherwise("Academia")
    return _t(spark, sf_dir, "orders").select("o_orderkey", classify.status(said).alias("status"), classify.body(head).alias("body"), classify.centre_kind(kind).alias("kind"))


@entry("""
SELECT lpad(c_custkey::VARCHAR, 8, '0') AS code, CASE WHEN c_custkey % 2 = 0 THEN 'IES ' ELSE '' END || 'Centre ' || c_custkey AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Official' ELSE 'Named' END || ' ' || c_nationkey AS municipality,
       CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE 'P' || c_nationkey END AS province, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS lat
FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_custkey > 0
""")
def centre_guide(spark, sf_dir):
    """The guide's rows in the published columns, closed centres and rows without a code left out."""
    c = F.col
    made = {
        "codcen": F.when(c("c_custkey") > 0, F.lpad(c("c_custkey").cast("string"), 8, "0")), "cod_estado": F.when(c("c_mktsegment") == "BUILDING", " l ").when(c("c_mktsegment") != "MACHINERY", "A").otherwise("B"),
        "dlibre": F.concat(F.lit("CENTRE  "), c("c_custkey")), "dgenerica_cas": F.when(c("c_custkey") % 2 == 0, "Instituto de Educación Secundaria"), "localidad_oficial": F.concat(F.lit("OFFICIAL "), c("c_nationkey")),
        "noms_mun": F.concat(F.lit("NAMED "), c("c_nationkey")), "provincia": F.when(c("c_nationkey") % 2 == 0, " ").otherwise(F.concat(F.lit("P"), c("c_nationkey"))), "latitud": F.when(c("c_acctbal") > 0, c("c_acctbal").cast("string")).otherwise(""),
    }
    # A name that shows its kind gets none: these begin with CENTRE, so their kind is put there by hand.
    made["dlibre"] = F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("IES "), made["dlibre"])).otherwise(made["dlibre"])
    guide = _t(spark, sf_dir, "customer").select(*[made.get(x, F.lit(None).cast("string")).alias(x) for x in centres.COLUMNS])
    return centres.centre_rows(guide).select("code", "name", "municipality", "province", "lat")


@entry("SELECT n_nationkey::VARCHAR AS key, n_name AS value FROM nation")
def literal_maps(spark, sf_dir):
    """Entries of object literals in scripts, one for each region."""
    pairs = F.array_join(F.collect_list(F.concat(F.lit("  "), F.col("n_nationkey").cast("string"), F.lit(': "'), "n_name", F.lit('"'))), ",\n")
    scripts = _t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("let a = 1;\nconst names = {\n"), pairs, F.lit("\n};\nconst other = {x: \"y\"};")).alias("js"))
    return lines.literal_map(scripts, "js", "names")


@entry("""
SELECT 'r/' || r_regionkey AS url, 0 AS depth FROM region UNION ALL SELECT 'n/' || n_nationkey, 1 FROM nation
UNION ALL SELECT * FROM (SELECT 's/' || s_suppkey AS url, 2 AS depth FROM supplier ORDER BY url LIMIT 10)
""")
def crawl_bound(spark, sf_dir):
    """Breadth first from regions over nations to suppliers, forty pages at most."""
    n = _t(spark, sf_dir, "nation").select(F.concat(F.lit("r/"), "n_regionkey").alias("url"), F.concat(F.lit("n/"), "n_nationkey").alias("target"))
    s = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("n/"), "s_nationkey").alias("url"), F.concat(F.lit("s/"), "s_suppkey").alias("target"))
    return html.crawl(n.unionByName(s), _t(spark, sf_dir, "region").select(F.concat(F.lit("r/"), "r_regionkey").alias("url")), 40)


# Pipelines


@entry("""
WITH a AS (SELECT l_shipdate::DATE::VARCHAR AS url, lpad(l_suppkey::VARCHAR, 8, '0') AS center_code, CASE WHEN l_returnflag = 'A' THEN '126' ELSE '3A1' END AS specialty_code, l_quantity::INT AS cut, l_suppkey,
                  CASE WHEN l_linestatus = 'F' THEN 'maestros' ELSE 'secundaria' END AS body, l_orderkey, l_linenumber, l_partkey FROM lineitem),
k AS (SELECT *, row_number() OVER (PARTITION BY url, center_code, specialty_code ORDER BY cut DESC, l_orderkey, l_linenumber, l_partkey) AS k FROM a WHERE (body = 'maestros') = (specialty_code = '126'))
SELECT url, center_code, specialty_code, cut, body, l_partkey::VARCHAR AS specialty_name, CASE WHEN l_suppkey % 2 = 0 THEN s_name ELSE 'Raw ' || l_suppkey END AS center_name FROM k LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE k = 1
""")
def document_cuts(spark, sf_dir):
    """Cuts of documents: owned awards, the greatest cut, the first of equals, the guide's name or the document's own."""
    c = F.col
    awards = _t(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("url"), F.lpad(c("l_suppkey").cast("string"), 8, "0").alias("center_code"), F.when(c("l_returnflag") == "A", "126").otherwise("3A1").alias("specialty_code"),
        c("l_quantity").cast("int").alias("cut"), F.when(c("l_linestatus") == "F", "maestros").otherwise("secundaria").alias("body"), (c("l_orderkey").cast("decimal(38,0)") * 10**12 + c("l_linenumber") * F.lit(10**11) + c("l_partkey")).alias("seq"),
        c("l_partkey").cast("string").alias("specialty_name"), F.concat(F.lit("RAW "), c("l_suppkey")).alias("center_name"), F.lit("TOWN").alias("locality"), F.lit("vacante").alias("placement_type"),
        F.lit(False).alias("english_requirement"), F.lit(False).alias("itinerant"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("published_date"), F.lit("h").alias("sha256"),
    )
    guide = _t(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select(F.lpad(c("s_suppkey").cast("string"), 8, "0").alias("code"), c("s_name").alias("name"), F.lit("T").alias("municipality"))
    return cuts.document_cuts(awards, guide).select("url", "center_code", "specialty_code", "cut", "body", "specialty_name", "center_name")


@entry("""
WITH m AS (SELECT max(date_trunc('month', o_orderdate)) AS m FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1998-07-01')
SELECT o_orderkey::INT AS offer_order, lpad(o_custkey::VARCHAR, 8, '0') AS center_code, 'vacante' AS placement_type FROM orders, m WHERE date_trunc('month', o_orderdate) = m
""")
def offers_update(spark, sf_dir):
    """Monthly snapshots of offers: the newest valid one of the school year replaces the state of the year before."""
    c, names = F.col, names_of(OFFERS)
    item = {"offer_order": c("o_orderkey").cast("string"), "center_code": F.lpad(c("o_custkey").cast("string"), 8, "0"), "placement_type": F.lit("vacante")}
    o = _t(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month")).withColumn("item", F.array(*[item.get(n, F.lit("")) for n in names]))
    from ..functions.calendar import school_year

    payloads = o.groupBy("month").agg(F.collect_list("item").alias("items")).select(
        F.lit(quality.OFFER_DATASET).alias("dataset"), F.lit(quality.OFFER_MODE).alias("update_mode"), school_year(c("month")).alias("academic_year"), F.lit(quality.OFFER_STATUS).alias("status"),
        c("month").cast("string").alias("publication_date"), F.array(*map(F.lit, names)).alias("item_fields"), "items", F.sha2(c("month").cast("string"), 256).alias("sha256"),
    )
    state = offers.item_rows(payloads.filter("academic_year = '1996-1997'"))
    return offers.update(state, payloads, "1997-1998").select("offer_order", "center_code", "placement_type")


@entry("""
WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, o_custkey % 3 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN y < 2000 AND y NOT IN (1998, 1999) WHEN 1 THEN y NOT IN (1998, 1999) ELSE false END AS outside FROM d
""")
def links_outside_year(spark, sf_dir):
    """Links whose text names other years than the target's, in four digits that begin with 20, or whose file name begins
    with another year's two digits."""
    c = F.col
    url = F.when(c("o_custkey") % 3 == 1, F.concat(F.lit("http://h/dir%2Fx/"), F.date_format("o_orderdate", "yyMMdd"), F.lit("_list.pdf"))).otherwise("http://h/list.pdf")
    words = F.when(c("o_custkey") % 3 == 0, F.concat(F.lit("curso "), F.year("o_orderdate") + 100)).otherwise("curso")
    return _t(spark, sf_dir, "orders").select("o_orderkey", cuts.outside_year(url, words, F.lit("2098-2099")).alias("outside"))


@entry("""
SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN true ELSE year(o_orderdate) + 20 IN (2017, 2018) END AS allowed, o_custkey % 2 = 0 AS overlap FROM orders
""")
def year_mentions(spark, sf_dir):
    """Texts that name school years, against those allowed on a date; text without a year is allowed."""
    y = F.year("o_orderdate") + 20
    said = F.when(F.col("o_custkey") % 4 == 0, "no year").otherwise(F.concat(F.lit("curso "), y, F.lit(" / "), y + 1))
    both = F.arrays_overlap(F.array(F.lit("a"), F.lit("b")), F.array(F.when(F.col("o_custkey") % 2 == 0, "b").otherwise("c")))
    from ..functions import calendar

    return _t(spark, sf_dir, "orders").select("o_orderkey", calendar.mentions_allowed_year(said, calendar.allowed_years(F.lit("2018-07-15").cast("date"))).alias("allowed"), both.alias("overlap"))


@entry("""
SELECT 'arity' AS rule, c_custkey AS key FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'coordinates', c_custkey FROM customer WHERE c_custkey % 5 = 0 OR c_acctbal < 0
""")
def centre_override_gate(spark, sf_dir):
    """Override rows of the wrong length or without finite coordinates."""
    filled = F.array(*[F.lit("x")] * 14)
    lat = F.when(F.col("c_acctbal") < 0, "Infinity").otherwise(F.col("c_acctbal").cast("string"))
    row = F.when(F.col("c_custkey") % 5 == 0, filled).otherwise(F.concat(filled, F.array(lat, F.lit("0.5"))))
    return quality.violations(_t(spark, sf_dir, "customer").select("c_custkey", row.alias("r")), "c_custkey", quality.override_rules("r", 16))


@entry("""
SELECT 'schema' AS rule, n_nationkey AS key FROM nation WHERE n_regionkey < 3 UNION ALL SELECT 'policy', n_nationkey FROM nation WHERE n_nationkey < 5
UNION ALL SELECT 'pdf_maestros', n_nationkey FROM nation WHERE n_nationkey % 2 = 1 UNION ALL SELECT 'fields', n_nationkey FROM nation WHERE n_nationkey % 3 = 0
""")
def cut_table_gate(spark, sf_dir):
    """Preconditions of cut tables."""
    c = F.col
    pdfs = F.create_map(F.lit("maestros"), F.when(c("n_nationkey") % 2 == 0, "digest").otherwise("other"))
    fields = F.array(*map(F.lit, quality.CUT_FIELDS))
    table = _t(spark, sf_dir, "nation").select("n_nationkey", c("n_regionkey").alias("schema_version"), c("n_nationkey").alias("policy_version"), pdfs.alias("pdfs"), F.when(c("n_nationkey") % 3 == 0, F.slice(fields, 1, 3)).otherwise(fields).alias("cut_format"))
    return quality.violations(table, "n_nationkey", quality.cut_table_rules({"maestros": "digest"}))


@entry("SELECT 'control_example' AS rule, s_suppkey AS key FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R' AND l_quantity = 50)")
def control_example_gate(spark, sf_dir):
    """Suppliers expected with a certain line, for which none is found."""
    expected = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit(7).alias("n"), F.lit("R").alias("f"), F.lit(50.0).alias("q"))
    found = _t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("f"), F.col("l_quantity").alias("q"))
    return quality.control_examples(found, expected, "k")


@entry("SELECT doc_id, doc_id % 4 = 0 AND text IS NOT NULL AS pdf FROM documents")
def magic_bytes(spark, sf_dir):
    """Whether bytes begin, after white space, as a PDF does."""
    head = F.when(F.col("doc_id") % 4 == 0, F.lit("\n %PDF-1.7 ")).otherwise("%PDX")
    return _t(spark, sf_dir, "documents").select("doc_id", quality.is_pdf(F.concat(head, "text").cast("binary")).alias("pdf"))


@entry("SELECT o_orderkey, min(o_custkey) AS o_custkey FROM orders GROUP BY 1")
def unambiguous_index(spark, sf_dir):
    """An index of one value for each key, which fails where a key has several."""
    return quality.unambiguous(_t(spark, sf_dir, "orders"), ["o_orderkey"], "o_custkey")


@entry("""
WITH RECURSIVE split AS (SELECT 'c' AS side, c_custkey AS id, c_nationkey AS nation, c_acctbal AS o FROM customer UNION ALL SELECT 's', s_suppkey, s_nationkey, s_acctbal FROM supplier),
keyed AS (SELECT side, id, n_name AS loose, left(n_name, (1 + id % 3)::INT) || ' ' || substr(n_name, (2 + id % 3)::INT) AS exact, row_number() OVER (PARTITION BY side, n_name ORDER BY o DESC, id) AS n FROM split JOIN nation ON nation = n_nationkey),
steps AS (
  SELECT loose, 0::BIGINT AS n, list({'i': id, 'e': exact} ORDER BY n) AS free, NULL::BIGINT AS c_custkey, NULL::BIGINT AS s_suppkey, 0 AS tier FROM keyed WHERE side = 's' GROUP BY loose
  UNION ALL
  SELECT loose, n, [x FOR x IN free IF x.i <> p.i], id, p.i, CASE WHEN p.e = exact THEN 1 ELSE 2 END
  FROM (SELECT keyed.*, free, coalesce([x FOR x IN free IF x.e = exact][1], free[1]) AS p FROM steps JOIN keyed ON keyed.side = 'c' AND keyed.loose = steps.loose AND keyed.n = steps.n + 1 WHERE len(free) > 0)
)
SELECT c_custkey, s_suppkey, tier FROM steps WHERE n > 0
""")
def occurrence_join_competing(spark, sf_dir):
    """Customers of a nation, the richest first, take suppliers: one whose nation is spelt with the same blank, else any."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    spelt = lambda i: F.concat(F.expr(f"left(n_name, cast(1 + {i} % 3 AS int))"), F.lit(" "), F.expr(f"substring(n_name, cast(2 + {i} % 3 AS int))")).alias("exact")
    side = lambda t, p, i: _t(spark, sf_dir, t).join(nation, F.col(f"{p}_nationkey") == F.col("n_nationkey")).select(i, F.col("n_name").alias("loose"), spelt(i), (-F.col(f"{p}_acctbal")).alias("o"))
    return joins.occurrence_join_competing(side("customer", "c", "c_custkey"), side("supplier", "s", "s_suppkey"), "exact", "loose", "c_custkey", "s_suppkey", ["o", "c_custkey"], ["o", "s_suppkey"])


@entry("""
WITH d AS (SELECT lpad(l_suppkey::VARCHAR, 8, '0') AS center_code, CASE WHEN l_linenumber % 2 = 0 THEN '126' ELSE '3A1' END AS specialty_code, CASE WHEN l_linenumber % 2 = 0 THEN 'maestros' ELSE 'secundaria' END AS body,
                  l_shipdate::DATE AS day, l_quantity::INT AS cut FROM lineitem),
best AS (SELECT center_code, specialty_code, body, day, max(cut) AS cut FROM d GROUP BY ALL),
starts AS (SELECT * FROM best WHERE day >= DATE '1998-07-01' AND day < DATE '1998-09-01'),
start AS (SELECT * FROM starts WHERE day = (SELECT max(day) FROM starts s WHERE s.body = starts.body)),
course AS (SELECT * FROM best WHERE day >= DATE '1998-09-01' QUALIFY row_number() OVER (PARTITION BY center_code, specialty_code, body ORDER BY day DESC) = 1)
SELECT center_code, specialty_code, body, cut, day::VARCHAR AS published_date, 'curso' AS origin FROM course
UNION ALL SELECT center_code, specialty_code, body, cut, day::VARCHAR, 'inicio' FROM start ANTI JOIN course USING (center_code, specialty_code, body)
""")
def start_then_course(spark, sf_dir):
    """Three updates: the course up to the summer of 1998, whose year ends there; the start of the next year, which
    empties and seeds the course; the new year's course. State is written between them, as users keep it."""
    from ..operators.merge import LEDGER
    from ..scratch import Scratch

    c, scratch = F.col, Scratch(spark, "start-then-course")
    even, day = c("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyyy-MM-dd")
    body = F.when(even, "maestros").otherwise("secundaria")
    awards = _t(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", body, day).alias("url"), F.lpad(c("l_suppkey").cast("string"), 8, "0").alias("center_code"), F.when(even, "126").otherwise("3A1").alias("specialty_code"),
        c("l_quantity").cast("int").alias("cut"), body.alias("body"), (c("l_orderkey").cast("decimal(38,0)") * 10**12 + c("l_linenumber") * F.lit(10**11) + c("l_partkey")).alias("seq"),
        c("l_partkey").cast("string").alias("specialty_name"), F.concat(F.lit("RAW "), c("l_suppkey")).alias("center_name"), F.lit("TOWN").alias("locality"), F.lit("vacante").alias("placement_type"),
        F.lit(False).alias("english_requirement"), F.lit(False).alias("itinerant"), day.alias("published_date"), F.sha2(F.concat_ws("-", body, day), 256).alias("sha256"),
    )
    guide = _t(spark, sf_dir, "supplier").select(F.lpad(c("s_suppkey").cast("string"), 8, "0").alias("code"), c("s_name").alias("name"), F.lit("T").alias("municipality"))
    empty = spark.createDataFrame([], "center_code string, specialty_code string, cut int, specialty_name string, center_name string, municipality string, body string, placement_type string, english_requirement boolean, itinerant boolean, origin string, school_year string, published_date string, url string")
    start, course, ledger = empty, empty, spark.createDataFrame([], LEDGER)
    for mode, own in (("curso", c("published_date") < "1998-07-01"), ("inicio", c("published_date").between("1998-07-01", "1998-08-31")), ("curso", c("published_date") > "1998-08-31")):
        after = cuts.run(start, course, ledger, awards.filter(own), guide, mode)
        start, course, ledger = (scratch.table(after[n].select(*old.columns), n) for n, old in (("start", start), ("course", course), ("ledger", ledger)))
    return course.select("center_code", "specialty_code", "body", "cut", "published_date", "origin")


@entry("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) AS k FROM orders)
SELECT o_orderpriority, count(*) AS n_rows, sum(o_orderkey % 10)::BIGINT AS total FROM o WHERE k = 1 GROUP BY 1
""")
def corrected_totals(spark, sf_dir):
    """Orders of even number, the latest of a customer as its document, corrected by those of odd number: totals by
    priority follow from signed changes."""
    from ..operators.versions import DocumentTotals
    from ..scratch import shared_dir

    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", (F.col("o_orderkey") % 10).alias("n"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in o.schema.fields)
    totals = DocumentTotals(spark, f"{shared_dir(spark)}/corrected-totals-{uuid.uuid4().hex}", schema, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderpriority"], "n", buckets=16)
    for part in (0, 1):
        totals.apply(o.filter(F.col("o_orderkey") % 2 == part))
    return totals.totals()


@entry("""
SELECT year(l_shipdate)::INT AS year, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity FROM lineitem WHERE year(l_shipdate) % 2 = 0 OR l_quantity >= 49 GROUP BY 1
""")
def partition_versions(spark, sf_dir):
    """Lines kept by year; the odd years are replaced by their large lines, the others' files stay."""
    from ..operators.versions import PartitionedState
    from ..scratch import shared_dir

    lines = _t(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("quantity"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema.fields)
    state = PartitionedState(spark, f"{shared_dir(spark)}/partition-versions-{uuid.uuid4().hex}", schema, F.col("year"))
    state.replace(lines)
    state.replace(lines.filter("year % 2 = 1 and quantity >= 49"))
    return state.read().groupBy("year").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


@entry("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey DESC) = 1")
def stream_newest(spark, sf_dir):
    """Orders as a stream: keyed state on disk holds each customer's newest, read back once all is taken in."""
    from ..scratch import shared_dir
    from ..streaming import keyed

    path, checkpoint = f"{sf_dir}/orders.parquet", f"{shared_dir(spark)}/stream-newest-{uuid.uuid4().hex}"
    # As a pattern, since a stream's path may be a folder or a pattern but not one file.
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{sf_dir}/orders.parque[t]")
    rows = stream.select("o_custkey", "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("d"))
    keyed.keep_newest(rows, checkpoint, ["o_custkey"], "d", ["o_orderkey"]).awaitTermination()
    return keyed.held_rows(spark, checkpoint).select("o_custkey", "o_orderkey", "o_totalprice")


@entry("""
SELECT p.event_id, coalesce(v.event_id, -1) AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1) v ON p.ts > v.ts
""")
def asof_one_key(spark, sf_dir):
    """The last view of anyone before each purchase: one key holds every row, ranges of time are filled apart."""
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.lit(1).alias("k"))
    views = ev.filter("event_type = 'view'").select("k", F.col("ts").alias("vts"), F.col("event_id").alias("view_id"))
    return joins.asof_join(ev.filter("event_type = 'purchase'"), views, ["k"], "ts", "vts", ["view_id"], spread=True).select("event_id", F.coalesce("view_id", F.lit(-1)).alias("view_id"))


@entry("SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (ORDER BY ts, event_id), -1) AS purchase_id FROM events")
def fill_one_key(spark, sf_dir):
    """The last purchase up to each event, over the whole table in one order."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", F.lit(1).alias("k"), F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("purchase_id"))
    return windows.forward_fill(ev, ["k"], ["ts", "event_id"], "purchase_id", spread=True).select("event_id", F.coalesce("purchase_id", F.lit(-1)).alias("purchase_id"))


_CRAWL = "o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place, o_orderkey % (SELECT max(o_custkey) FROM orders) AS url, o_orderpriority AS text, CASE WHEN o_orderstatus = 'F' THEN left(o_orderpriority, 1) END AS own, o_orderkey % 3 > 0 AS follows"


@entry(f"""
WITH RECURSIVE e AS (SELECT {_CRAWL} FROM orders),
walk AS (
  SELECT 1::BIGINT AS url, [0::BIGINT] AS path, NULL::VARCHAR AS label, 0 AS depth
  UNION ALL
  SELECT url, path, label, depth FROM (
    SELECT e.url, list_append(walk.path, e.place) AS path, coalesce(e.own, walk.label) AS label, walk.depth + 1 AS depth, row_number() OVER (PARTITION BY e.url ORDER BY list_append(walk.path, e.place)) AS k
    FROM walk JOIN e ON e.page = walk.url AND e.follows WHERE walk.depth < 4
  ) WHERE k = 1
),
seen AS (SELECT url, depth, path, label FROM walk QUALIFY row_number() OVER (PARTITION BY url ORDER BY depth, path) = 1),
pages AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY depth, path) AS nth FROM seen) WHERE nth <= 30)
SELECT e.page::BIGINT AS page, e.place::INT AS place, e.url::BIGINT AS url, coalesce(own, label) AS label, depth::INT AS depth, nth::INT AS nth
FROM pages JOIN e ON e.page = pages.url AND NOT follows WHERE coalesce(own, label) IS NOT NULL
""")
def crawl_documents(spark, sf_dir):
    """Customers as pages, their orders as links to other customers or (one in three) to documents; what an order names
    goes to the pages and documents behind it."""
    from pyspark.sql import Window as W

    c, o = F.col, _t(spark, sf_dir, "orders")
    pages = o.agg(F.max("o_custkey").alias("m"))  # one row
    place = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    links = o.join(F.broadcast(pages)).select(c("o_custkey").alias("page"), place.alias("place"), (c("o_orderkey") % c("m")).alias("url"), c("o_orderpriority").alias("text"), "o_orderstatus", (c("o_orderkey") % 3).alias("kind"))
    links = links.withColumn("text", F.concat_ws("|", "text", "o_orderstatus", "kind"))
    parts = F.split("text", "[|]")
    own = F.when(parts[1] == "F", F.substring(parts[0], 1, 1))
    roots = spark.range(1).select(F.lit(1).cast("long").alias("url"))
    visited, documents = html.crawl_documents(links, roots, own, parts[2] != "0", parts[2] == "0", 30)
    nth = visited.select(F.col("url").alias("page"), "depth", "nth")
    return documents.join(nth, "page").select("page", "place", "url", "label", "depth", "nth")


@entry("""
WITH c AS (SELECT c_custkey // 40 AS page, c_custkey % 40 AS n, c_name, c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'no ' || c_nationkey END AS third FROM customer)
SELECT page::BIGINT AS page, (row_number() OVER (PARTITION BY page ORDER BY n) - 1)::INT AS row, c_name || '|' || c_mktsegment || CASE WHEN max(third) OVER (PARTITION BY page) = '' THEN '' ELSE '|' || third END AS cells FROM c
""")
def cell_grids(spark, sf_dir):
    """Customers set as tables of forty rows a page: words with places go in, rows of cells come out."""
    c = F.col
    page, top = F.floor(c("c_custkey") / 40).alias("page"), (F.lit(80.0) + 12 * (c("c_custkey") % 40))
    word = lambda text, x0, down=0.0: F.struct(text.alias("text"), F.lit(float(x0)).alias("x0"), (F.lit(float(x0)) + 5 * F.length(text)).alias("x1"), (top + down).alias("top"))
    third = F.when(c("c_custkey") % 3 != 0, F.array(word(c("c_nationkey").cast("string"), 330, 0.8), word(F.lit("no"), 315))).otherwise(F.array())
    words = _t(spark, sf_dir, "customer").select(page, F.explode(F.concat(F.array(word(c("c_name"), 40, 0.4), word(c("c_mktsegment"), 200)), third)).alias("w")).select("page", "w.*")
    return lines.cell_grid(words, ["page"]).select("page", F.posexplode("cells").alias("row", "c")).select("page", "row", F.array_join("c", "|").alias("cells"))


@entry("""
WITH o AS (SELECT c_custkey, o_orderkey, 'q' || quarter(o_orderdate) AS doc, max(o_orderdate::DATE) OVER (PARTITION BY quarter(o_orderdate)) AS day,
                  CASE o_orderkey % 9 WHEN c_custkey % 7 THEN 0 WHEN c_custkey % 7 + 1 THEN 1 END AS exact
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1996-07-01' AND o_orderdate < TIMESTAMP '1997-07-01'),
b AS (SELECT *, coalesce(bool_or(exact = 0) OVER before, false) AS had0, coalesce(bool_or(exact = 1) OVER before, false) AS had1 FROM o
      WINDOW before AS (PARTITION BY c_custkey ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)),
r AS (SELECT *, coalesce(exact, CASE WHEN had0 AND NOT had1 THEN 0 WHEN had1 AND NOT had0 THEN 1 END) AS position FROM b)
SELECT c_custkey::INT AS person_index, position::INT AS position_index, (c_custkey % 7 + position)::INT AS after_order, day::VARCHAR AS published_date, doc AS source_url, o_orderkey::VARCHAR AS workload
FROM r WHERE position IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c_custkey, position ORDER BY day DESC, o_orderkey) = 1
""")
def assignments_through_course(spark, sf_dir):
    """Orders as awards in four documents of a course. A customer has two profiles of one name: the order that an award
    names tells them apart, and later awards that name none go to the one profile that had one before."""
    from pyspark.sql import Window as W

    from ..pipelines import assignments

    c, quarter = F.col, F.concat(F.lit("q"), F.quarter("o_orderdate"))
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = _t(spark, sf_dir, "orders").join(customers.select(c("c_custkey").alias("o_custkey"), "c_name").hint("merge"), "o_custkey").withColumn("url", quarter)
    in_year = F.to_date("o_orderdate").between("1996-07-01", "1997-06-30")
    day = F.when(in_year, F.date_format(F.max(F.when(in_year, F.to_date("o_orderdate"))).over(W.partitionBy("url")), "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    awards = o.select(
        "url", F.sha2("url", 256).alias("sha256"), day.alias("published_date"), c("o_orderkey").alias("seq"), (c("o_orderkey") % 9).cast("int").alias("cut"), c("c_name").alias("candidate_name"), F.lit("03000001").alias("center_code"),
        F.lit("3A1").alias("specialty_code"), F.lit("S").alias("specialty_name"), F.lit("C").alias("center_name"), F.lit("L").alias("locality"), F.lit("secundaria").alias("body"), F.lit("vacante").alias("placement_type"),
        F.lit(False).alias("english_requirement"), c("o_orderkey").cast("string").alias("workload"), F.lit(False).alias("itinerant"),
    )
    two = customers.select(c("c_custkey").cast("int").alias("person_index"), F.explode(F.array(F.lit(0), F.lit(1))).alias("position_index"), c("c_name").alias("official_name"))
    profiles = two.select("*", F.lit("3A1").alias("specialty_code"), F.lit("secundaria").alias("body"), (c("person_index") % 7 + c("position_index")).cast("int").alias("after_order"), F.lit(None).cast("int").alias("initial_order"))
    out = assignments.run(spark.createDataFrame([], assignments.ASSIGNMENTS), spark.createDataFrame([], assignments.SKIPPED), awards, profiles, "1996-1997", "1996-1997", "curso")
    return out["state"].select("person_index", "position_index", "after_order", "published_date", "source_url", "workload")


def _snapshots(spark, sf_dir):
    """Monthly snapshots: heads, some of which break a rule, and their items as rows; the last month of 1997 has none."""
    from ..functions.calendar import school_year

    c, names = F.col, names_of(OFFERS)
    o = _t(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month")).withColumn("sha256", F.sha2(c("month").cast("string"), 256)).withColumn("m", F.month("month"))
    heads = o.groupBy("month", "sha256", "m").agg(F.lit(1).alias("one")).select(
        "sha256", F.when(c("m") == 3, "other").otherwise(quality.OFFER_DATASET).alias("dataset"), F.lit(quality.OFFER_MODE).alias("update_mode"), school_year(c("month")).alias("academic_year"),
        F.when(c("m") == 4, "draft").otherwise(quality.OFFER_STATUS).alias("status"), F.when(c("m") == 5, "soon").otherwise(c("month").cast("string")).alias("publication_date"),
        F.when(c("m") == 6, F.array(F.lit("x"))).otherwise(F.array(*map(F.lit, names))).alias("item_fields"), "month",
    )
    order = F.when((c("m") == 8) & (c("o_orderkey") % 2 == 0), "1").otherwise(c("o_orderkey").cast("string"))
    item = {"offer_order": order, "center_code": F.when((c("m") == 9) & (c("o_custkey") % 50 == 0), "x").otherwise(F.lpad(c("o_custkey").cast("string"), 8, "0")), "placement_type": F.when((c("m") == 10) & (c("o_custkey") % 50 == 0), "?").otherwise("vacante")}
    cells = F.array(*[item.get(n, F.lit("")) for n in names])
    items = o.filter("month <> date'1997-12-01'").select("sha256", F.when((c("m") == 11) & (c("o_custkey") % 50 == 0), F.slice(cells, 1, len(names) - 1)).otherwise(cells).alias("item"))
    return heads, items


_SNAPSHOTS = """
WITH o AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, month(o_orderdate) AS m, o_orderkey, o_custkey, o_custkey % 50 = 0 AS odd, o_orderkey % 2 = 0 AS even FROM orders),
h AS (SELECT month, m, CASE WHEN m >= 7 THEN year(month) ELSE year(month) - 1 END AS y, bool_or(odd) AS odd, sum(even::INT) AS evens, count_if(NOT even AND o_orderkey = 1) AS ones FROM o GROUP BY ALL),
broken AS (
  SELECT 'year' AS rule, month FROM h WHERE y <> 1997 UNION ALL SELECT 'dataset', month FROM h WHERE m = 3 UNION ALL SELECT 'status', month FROM h WHERE m = 4 UNION ALL SELECT 'date', month FROM h WHERE m = 5 UNION ALL SELECT 'fields', month FROM h WHERE m = 6
  UNION ALL SELECT 'items', month FROM h WHERE month = DATE '1997-12-01' UNION ALL SELECT 'distinct_orders', month FROM h WHERE m = 8 AND evens + ones > 1 UNION ALL SELECT 'centre_codes', month FROM h WHERE m = 9 AND odd
  UNION ALL SELECT 'placements', month FROM h WHERE m IN (10, 11) AND odd UNION ALL SELECT 'whole_items', month FROM h WHERE m = 11 AND odd
)
"""


@entry(_SNAPSHOTS + "SELECT rule, sha256(month::VARCHAR) AS key FROM broken")
def offer_payload_gate(spark, sf_dir):
    """Rules that monthly snapshots break, their items checked as rows."""
    heads, items = _snapshots(spark, sf_dir)
    return quality.offer_snapshot_violations(heads.drop("month"), items, F.lit("1997-1998"), names_of(OFFERS))


@entry(_SNAPSHOTS + """, newest AS (SELECT max(month) AS month FROM h WHERE month NOT IN (SELECT month FROM broken))
SELECT o_orderkey::INT AS offer_order, lpad(o_custkey::VARCHAR, 8, '0') AS center_code FROM o JOIN newest USING (month)""")
def offers_update_rows(spark, sf_dir):
    """The newest valid snapshot of the year replaces the state of the year before, item by item."""
    heads, items = _snapshots(spark, sf_dir)
    state = spark.createDataFrame([], "academic_year string, publication_date string, sha256 string, " + OFFERS)
    return offers.update_from_items(state, heads.drop("month"), items, "1997-1998").select("offer_order", "center_code")


@entry("""
SELECT o_orderkey, (o_orderkey % 90000 + 1)::INT AS cut, CASE WHEN o_orderstatus = 'F' THEN '2B1' ELSE '3A1' END AS specialty_code, 'PAGE NAME' AS specialty_name, o_custkey % 3 = 0 AS itinerant
FROM orders WHERE CASE WHEN o_orderstatus = 'F' THEN '2B1' ELSE '3A1' END = CASE WHEN o_custkey % 4 = 0 THEN '2B1' WHEN o_custkey % 4 < 3 THEN '3A1' END
""")
def award_blocks_of_pages(spark, sf_dir):
    """Awards of the other bodies count where the page's specialty is the awarded one; its name is the page's."""
    c = F.col
    rows = F.array(
        F.concat((c("o_orderkey") % 90000 + 1).cast("string"), F.lit(" PERSON "), c("o_custkey"), F.lit(", ANA")), F.lit("921979 TOWN(03000001)SCHOOL"),
        F.concat(F.when(c("o_orderstatus") == "F", "2B1").otherwise("3A1"), F.lit(" / OWN NAME")), F.concat_ws(" ", F.lit("Adjudicat VACANT"), F.when(c("o_custkey") % 3 == 0, "Itinerant")),
    )
    page = F.when(c("o_custkey") % 4 == 0, "2B1").when(c("o_custkey") % 4 < 3, "3A1")
    made = _t(spark, sf_dir, "orders").select("o_orderkey", rows.alias("lines"), F.lit("secundaria").alias("body"), F.when(page.isNotNull(), F.struct(page.alias("code"), F.lit("PAGE NAME").alias("name"))).alias("page_specialty"))
    return blocks.awards(made).filter("award is not null").select("o_orderkey", *[f"award.{x}" for x in ("cut", "specialty_code", "specialty_name", "itinerant")])

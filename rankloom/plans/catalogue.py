"""Catalogue entries: name -> (query, SQL or None). Each applies an operator to the given tables as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, classify, text
from ..operators import aggregates, joins, merge, quality, windows
from ..sources import html, lines

ENTRIES: dict = {}


def entry(sql: str | None):
    def add(f):
        ENTRIES[f.__name__] = (f, sql)
        return f

    return add


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark, sf_dir):
    return _t(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


# Joins


@entry("""
WITH x AS (SELECT l_suppkey, p_brand, l_extendedprice, l_orderkey, l_linenumber,
                  row_number() OVER (PARTITION BY l_suppkey, p_brand ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_suppkey, p_brand, s_name, l_extendedprice AS price, l_orderkey, l_linenumber
FROM x LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE k = 1
""")
def cut_max_by_key(spark, sf_dir):
    """Best line for each supplier and brand: the greatest price, of equals the first by order and line; with the supplier's name."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    seq = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    best = aggregates.argmax_first(rows.join(parts, "l_partkey").withColumn("seq", seq), ["l_suppkey", "p_brand"], "l_extendedprice", "seq", ["l_extendedprice", "l_orderkey", "l_linenumber"])
    named = joins.lookup(best, _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), ["l_suppkey"], {})
    return named.select("l_suppkey", "p_brand", "s_name", F.col("l_extendedprice").alias("price"), "l_orderkey", "l_linenumber")


@entry("""
SELECT o_orderkey, coalesce(c_name, 'customer ' || o_custkey) AS name FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
""")
def lookup_with_fallback(spark, sf_dir):
    dim = _t(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return joins.lookup(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), dim, ["o_custkey"], {"name": F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))}).select("o_orderkey", "name")


@entry("""
WITH d AS (SELECT event_type AS k, min(event_id) AS first_id FROM events GROUP BY 1)
SELECT event_id, coalesce(CASE WHEN month(ts) = 1 AND day(ts) <= 15 THEN first_id END, -1) AS first_id
FROM events LEFT JOIN d ON k = CASE event_type WHEN 'error' THEN 'view' ELSE event_type END
""")
def alias_guarded_lookup(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    dim = ev.groupBy("event_type").agg(F.min("event_id").alias("first_id"))
    alias = {"event_type": F.coalesce(classify.lookup({"error": "view"}, F.col("event_type")), F.col("event_type"))}
    return joins.guarded_lookup(ev, dim, ["event_type"], "first_id", (F.month("ts") == 1) & (F.dayofmonth("ts") <= 15), alias).select("event_id", F.coalesce("first_id", F.lit(-1)).alias("first_id"))


@entry("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def ledger_anti(spark, sf_dir):
    """Customers that the ledger of urgent orders lacks."""
    ledger = _t(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_seen(_t(spark, sf_dir, "customer"), ledger, "c_custkey").select("c_custkey", "c_name")


@entry("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def semi_membership(spark, sf_dir):
    return _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@entry("""
SELECT doc_id FROM documents d WHERE NOT EXISTS
 (SELECT 1 FROM (SELECT sha256(text) AS h, min(doc_id) AS low FROM documents GROUP BY 1) WHERE h = sha256(d.text) AND low <> d.doc_id)
""")
def hash_dup_anti(spark, sf_dir):
    """Documents whose content is not in the ledger of first copies under another id."""
    docs = lines.fingerprint(_t(spark, sf_dir, "documents").select("doc_id", "text"), "text").select("doc_id", "sha256")
    return joins.not_seen_elsewhere(docs, docs.groupBy("sha256").agg(F.min("doc_id").alias("doc_id")), "sha256", "doc_id").select("doc_id")


@entry("""
WITH c AS (SELECT c_custkey AS k, c_name FROM customer), s AS (SELECT s_suppkey AS k, s_name FROM supplier),
one AS (SELECT k FROM c GROUP BY k HAVING count(*) = 1 INTERSECT SELECT k FROM s GROUP BY k HAVING count(*) = 1)
SELECT k, c_name, s_name, 'both' AS source FROM c JOIN s USING (k) WHERE k IN (FROM one)
UNION ALL SELECT k, c_name, NULL, 'left' FROM c WHERE k NOT IN (FROM one)
UNION ALL SELECT k, NULL, s_name, 'right' FROM s WHERE k NOT IN (FROM one)
""")
def full_outer_guarded(spark, sf_dir):
    """Keys that are single on both sides fuse, all other rows stay as they are."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    s = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    return joins.guarded_full_outer(c, s, "k", ["c_name"], ["s_name"])


@entry("""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events)
SELECT a.event_id, coalesce(b.event_id, -1) AS purchase_id FROM e a LEFT JOIN e b ON a.user_id = b.user_id AND a.n = b.n AND b.event_type = 'purchase'
WHERE a.event_type = 'click'
""")
def occurrence_join(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    clicks, buys = ev.filter("event_type = 'click'"), ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bts"))
    return joins.occurrence_join(clicks, buys, ["user_id"], ["ts", "event_id"], ["bts", "purchase_id"]).select("event_id", F.coalesce("purchase_id", F.lit(-1)).alias("purchase_id"))


_TIERS = """
WITH e AS (SELECT event_id, event_type, ts, user_id || ':' || day(ts) AS exact, user_id::VARCHAR AS loose FROM events WHERE event_type IN ('click', 'purchase')),
n1 AS (SELECT *, row_number() OVER (PARTITION BY exact, event_type ORDER BY ts, event_id) AS n FROM e),
t1 AS (SELECT a.event_id, b.event_id AS purchase_id FROM n1 a JOIN n1 b USING (exact, n) WHERE a.event_type = 'click' AND b.event_type = 'purchase'),
n2 AS (SELECT *, row_number() OVER (PARTITION BY loose, event_type ORDER BY ts, event_id) AS n FROM e
       WHERE CASE event_type WHEN 'click' THEN event_id NOT IN (SELECT event_id FROM t1) ELSE event_id NOT IN (SELECT purchase_id FROM t1) END)
SELECT *, 1 AS tier FROM t1 UNION ALL
SELECT a.event_id, b.event_id, 2 FROM n2 a JOIN n2 b USING (loose, n) WHERE a.event_type = 'click' AND b.event_type = 'purchase'
"""


@entry(_TIERS)
def occurrence_join_fallback(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", "ts", F.concat_ws(":", "user_id", F.dayofmonth("ts")).alias("exact"), F.col("user_id").cast("string").alias("loose"))
    clicks, buys = ev.filter("event_type = 'click'"), ev.filter("event_type = 'purchase'").withColumnRenamed("event_id", "purchase_id")
    return joins.occurrence_join_fallback(clicks, buys, "exact", "loose", "event_id", "purchase_id", ["ts", "event_id"], ["ts", "purchase_id"])


@entry("""
SELECT p.event_id, coalesce(v.event_id, -1) AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts > v.ts
""")
def asof_context(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    views = ev.filter("event_type = 'view'").select("user_id", F.col("ts").alias("vts"), F.col("event_id").alias("view_id"))
    return joins.asof_join(ev.filter("event_type = 'purchase'"), views, ["user_id"], "ts", "vts", ["view_id"]).select("event_id", F.coalesce("view_id", F.lit(-1)).alias("view_id"))


@entry("""
SELECT e.event_id, s.event_id AS opened_by FROM events e
ASOF JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'signup' GROUP BY 1, 2) s ON e.user_id = s.user_id AND e.ts >= s.ts
""")
def interval_blocks(spark, sf_dir):
    """Each event with the signup whose stretch it falls in."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    starts = ev.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("sts"), F.col("event_id").alias("opened_by"))
    return joins.block_join(ev, starts, ["user_id"], "ts", "sts", ["opened_by"]).select("event_id", "opened_by")


@entry("""
WITH x AS (SELECT a.p_partkey AS a, b.p_partkey AS b, 1 - levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name)) AS s
           FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS k FROM x)
SELECT a, b, round(s, 6) AS score FROM r LEFT JOIN (SELECT a, s AS second FROM r WHERE k = 2) USING (a)
WHERE k = 1 AND s >= 0.5 AND s - coalesce(second, 0) >= 0.05
""")
def fuzzy_top1_margin(spark, sf_dir):
    """The likest other part of the same brand and size, if it is like enough and ahead of the second."""
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("a"), "p_name", "p_brand", "p_size")
    best = joins.likest_with_margin(p, ["p_brand", "p_size"], "a", "p_name", 0.5, 0.05)
    return best.withColumn("score", F.round("score", 6))


@entry(None)
def fuzzy_greedy(spark, sf_dir):
    """Names of parts, changed a little, find their part again within the brand, each row once."""
    p = _t(spark, sf_dir, "part").select("p_brand", "p_partkey", text.identity_key(F.col("p_name")).alias("k"))
    changed = p.select("p_brand", F.col("p_partkey").alias("record"), F.concat(F.expr("substring(k, 2)"), F.lit("X")).alias("k"))
    return joins.fuzzy_match(changed, p, "p_brand", "record", "k", "p_partkey", "k", 0.8, 0.02)


@entry("""
WITH t1 AS (SELECT o_orderkey, any_value(c_custkey) AS c FROM orders JOIN customer ON o_custkey = c_custkey AND o_orderpriority LIKE '1%' GROUP BY 1 HAVING count(*) = 1),
g AS (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS c FROM customer GROUP BY 1, 2 HAVING count(DISTINCT c_custkey) = 1),
rest AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t1))
SELECT o_orderkey, c AS c_custkey, 1 AS tier FROM t1
UNION ALL SELECT o_orderkey, c, 2 FROM rest JOIN g ON c_nationkey = o_custkey % 25 AND c_mktsegment = 'BUILDING'
""")
def entity_cascade(spark, sf_dir):
    """By customer key for urgent orders, else by nation and segment if that is one customer."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_custkey")).alias("k"), (F.col("o_custkey") % 25).cast("int").alias("n"), F.lit("BUILDING").alias("s"))
    c = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("s"))
    return joins.cascade(o, c, "o_orderkey", "c_custkey", [["k"], ["n", "s"]])


@entry("""
SELECT s_suppkey, CASE WHEN c_custkey IS NOT NULL THEN c_name ELSE s_name END AS s_name, CASE WHEN c_custkey IS NOT NULL THEN c_acctbal ELSE s_acctbal END AS s_acctbal
FROM supplier LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = s_suppkey
""")
def update_columns(spark, sf_dir):
    new = _t(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"), F.col("c_acctbal").alias("s_acctbal"))
    return joins.update_columns(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), new, "s_suppkey", ["s_name", "s_acctbal"])


@entry("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN o_orderstatus END AS status FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def propagate_origin(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", F.lit(None).cast("string").alias("status"))
    src = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"))
    return joins.propagate(li, src, ["l_orderkey"], "status", F.col("l_returnflag") == "N").drop("l_returnflag")


@entry("SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 2")
def having_both(spark, sf_dir):
    return joins.groups_with_all(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", ["A", "R"])


# Aggregations


@entry("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def latest_doc_per_group(spark, sf_dir):
    return aggregates.argmax_last(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey", ["o_orderkey", "o_orderdate"])


@entry("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1")
def argmax_first_tie(spark, sf_dir):
    return aggregates.argmax_first(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])


@entry("""
SELECT p_type, count(*) FILTER (WHERE l_returnflag = 'N') AS n_open, count(*) FILTER (WHERE l_returnflag = 'N' AND p_size < 25) AS n_small, count(*) AS n_all
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
""")
def vacancy_counts(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    open_ = F.col("l_returnflag") == "N"
    return aggregates.count_where(li.join(p, "l_partkey"), ["p_type"], {"n_open": open_, "n_small": open_ & (F.col("p_size") < 25), "n_all": F.lit(True)})


@entry("""
WITH r AS (SELECT CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS o, l_linestatus AS i FROM lineitem),
g AS (SELECT o, i, count(*) AS n, grouping(o) AS go, grouping(i) AS gi FROM r GROUP BY GROUPING SETS ((o, i), (o), (i), ()))
SELECT CASE WHEN go = 1 AND gi = 1 THEN 'all' WHEN go = 1 THEN 'l_linestatus' WHEN gi = 1 THEN 'l_returnflag' ELSE 'l_returnflag,l_linestatus' END AS level,
       o AS l_returnflag, i AS l_linestatus, n FROM g WHERE go = 1 OR o IS NOT NULL
""")
def rollup_levels(spark, sf_dir):
    return aggregates.rollup_levels(_t(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", known=["A", "N"])


@entry("""
SELECT c_nationkey, arg_max(c_name, (c_acctbal, c_custkey)) AS last_all, arg_max(c_name, (c_acctbal, c_custkey)) FILTER (WHERE c_mktsegment = 'BUILDING') AS last_in,
       arg_max(c_name, (c_acctbal, c_custkey)) FILTER (WHERE c_mktsegment <> 'BUILDING') AS last_out FROM customer GROUP BY 1
""")
def filtered_argmax3(spark, sf_dir):
    in_ = F.col("c_mktsegment") == "BUILDING"
    return aggregates.filtered_argmax(_t(spark, sf_dir, "customer"), ["c_nationkey"], ["c_acctbal", "c_custkey"], "c_name", {"last_all": None, "last_in": in_, "last_out": ~in_})


@entry("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def distinct_first(spark, sf_dir):
    return aggregates.distinct_first(_t(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id"])


@entry("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def distinct_last(spark, sf_dir):
    return aggregates.distinct_last(_t(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id"])


@entry("""
SELECT user_id, hour, count(*) AS n, min(event_id) AS first, list_sort(list(event_id))[2] AS second
FROM (SELECT *, date_trunc('hour', ts)::VARCHAR AS hour FROM events) GROUP BY 1, 2 HAVING count(*) > 1
""")
def dup_report(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("hour"))
    return aggregates.duplicates(ev, ["user_id", "hour"], "event_id")


@entry("""
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS o_orderstatus,
       arg_max(o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END) AS highest_o_orderpriority,
       min(o_orderdate) AS first_date, max(o_orderdate) AS latest_date FROM orders GROUP BY 1
""")
def attr_merge(spark, sf_dir):
    ranks = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
    return aggregates.merged_attributes(_t(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderstatus"], {"o_orderpriority": ranks}, {"first_date": "o_orderdate"}, {"latest_date": "o_orderdate"})


@entry("SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1")
def ambiguous_keys(spark, sf_dir):
    return aggregates.ambiguous(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


@entry("SELECT user_id, max(n) AS profiles FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def profile_count(spark, sf_dir):
    return aggregates.profile_count(_t(spark, sf_dir, "events"), "user_id", "event_type")


@entry("SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def array_map_ops(spark, sf_dir):
    m = aggregates.sorted_counts(_t(spark, sf_dir, "events"), ["user_id"], "event_type")
    return m.select("user_id", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("counts"))


# Windows


@entry("""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN c > 0 THEN sum(c) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice)::BIGINT END, -1) AS credit
FROM (SELECT *, (l_returnflag = 'R')::INT + (l_discount > 0.05)::INT AS c FROM lineitem)
""")
def credential_running_sum(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_discount", "l_extendedprice")
    c = (F.col("l_returnflag") == "R").cast("int") + (F.col("l_discount") > 0.05).cast("int")
    return windows.running_sum(li, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], c, "credit").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.coalesce("credit", F.lit(-1)).cast("long").alias("credit"))


@entry("""
WITH e AS (SELECT *, epoch_us(ts) AS us FROM events)
SELECT event_id, coalesce(sum((event_type = 'view')::INT) OVER w, 0)::BIGINT AS views, coalesce(sum((event_type = 'click')::INT) OVER w, 0)::BIGINT AS clicks,
       coalesce(sum((event_type = 'purchase')::INT) OVER w, 0)::BIGINT AS purchases
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def ahead_counts(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "us")
    return windows.counts_ahead(ev, ev, ["user_id"], "us", "us", "event_type", {"views": "view", "clicks": "click", "purchases": "purchase"}).select("event_id", "views", "clicks", "purchases")


@entry("""
WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part), d AS (SELECT DISTINCT * FROM w)
SELECT p_partkey, token, row_number() OVER (PARTITION BY token ORDER BY p_partkey) AS ordinal FROM d
""")
def running_ordinal_exploded(spark, sf_dir):
    tokens = _t(spark, sf_dir, "part").select("p_partkey", F.explode(F.array_distinct(F.split("p_name", " "))).alias("token"))
    return windows.ordinal(tokens, ["token"], ["p_partkey"], spread=True)  # few tokens, each in many rows


@entry("""
SELECT c_custkey, 1 + coalesce(sum((c_acctbal > 0)::INT) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS active_rank FROM customer
""")
def active_ahead_rank(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return windows.active_rank(c, ["c_nationkey"], ["c_acctbal", "c_custkey"], F.col("c_acctbal") > 0, "active_rank", spread=True).select("c_custkey", F.col("active_rank").cast("long").alias("active_rank"))


@entry("""
WITH n AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), e AS (SELECT *, coalesce(lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber), 0) + 1 AS expected FROM n)
SELECT l_orderkey, l_linenumber, expected FROM e WHERE l_linenumber <> expected
""")
def gap_check(spark, sf_dir):
    return windows.gaps(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey"], "l_linenumber")


@entry("""
SELECT l_orderkey, min(l_linenumber) AS low, max(l_linenumber) AS high, count(*) AS n, count(DISTINCT l_linenumber) AS n_distinct FROM lineitem GROUP BY 1
HAVING min(l_linenumber) <> 1 OR max(l_linenumber) <> count(*) OR count(DISTINCT l_linenumber) <> count(*)
""")
def completeness_check(spark, sf_dir):
    return windows.incomplete(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@entry("""
SELECT event_id, block FROM (SELECT *, sum((event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS block FROM events) WHERE block > 0
""")
def block_start(spark, sf_dir):
    return windows.blocks_by_start(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup").select("event_id", "block")


@entry("""
SELECT event_id, coalesce(sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS block FROM events
""")
def block_end(spark, sf_dir):
    return windows.blocks_by_end(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error").select("event_id", "block")


@entry("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_paid FROM events
""")
def forward_fill(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").withColumn("paid", F.when(F.col("event_type") == "purchase", F.col("value")))
    return windows.forward_fill(ev, ["user_id"], ["ts", "event_id"], "paid", "last_paid").select("event_id", "last_paid")


@entry("""
SELECT event_id FROM (SELECT *, max((event_type = 'purchase')::INT) OVER (PARTITION BY user_id) AS a FROM
  (SELECT * FROM (SELECT *, max(ts::DATE) OVER (PARTITION BY user_id) AS m FROM events) WHERE ts::DATE = m)) WHERE (event_type = 'purchase')::INT = a
""")
def conditional_group_filter(spark, sf_dir):
    """Events of each user's newest day; where it has purchases, only these."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("d"))
    return windows.preferred_only(windows.newest_only(ev, ["user_id"], "d"), ["user_id"], F.col("event_type") == "purchase").select("event_id")


@entry("SELECT event_id FROM events WHERE event_type = 'refund' OR (NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'refund') AND event_type = 'purchase')")
def fallback_relation(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return windows.or_else(ev.filter("event_type = 'refund'"), ev.filter("event_type = 'purchase'")).select("event_id")


@entry("SELECT p_partkey, row_number() OVER (ORDER BY lower(p_type), nullif(p_size, 1) NULLS LAST, p_partkey) AS place FROM part")
def sorted_normalized(spark, sf_dir):
    """Places in a normalised order with nulls last."""
    p = _t(spark, sf_dir, "part").select("p_partkey", text.folded(F.col("p_type")).alias("t"), F.nullif(F.col("p_size"), F.lit(1)).alias("s"))
    return windows.text_order(p, [F.col("t"), F.col("s"), F.col("p_partkey")]).select("p_partkey", "place")


@entry("SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k <= 3")
def top_k_per_group(spark, sf_dir):
    return windows.top_per_group(_t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 3)


# Merges. The base is one half of a table and the batch the other.


def _halves(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("d"))
    return o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1")


@entry("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def upsert_lww(spark, sf_dir):
    base, batch = _halves(spark, sf_dir)
    return merge.upsert(base, batch, ["o_custkey"], ["d", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@entry("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE DESC, o_orderkey % 2 DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def upsert_dated(spark, sf_dir):
    base, batch = (x.withColumn("d", F.to_date("d")) for x in _halves(spark, sf_dir))
    return merge.dated_upsert(base, batch, ["o_custkey"], "d", ["o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@entry("""
SELECT o_orderkey, o_orderpriority FROM orders WHERE (o_orderkey % 2 = 0 AND o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE o_orderkey % 2 = 1 AND o_totalprice > 250000))
 OR (o_orderkey % 2 = 1 AND o_totalprice > 250000)
""")
def partition_replace(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return merge.replace_partitions(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1 and o_totalprice > 250000"), "o_orderpriority").select("o_orderkey", "o_orderpriority")


@entry("SELECT event_id FROM events WHERE ts::DATE = (SELECT max(ts::DATE) FROM events)")
def snapshot_replace(spark, sf_dir):
    """The state are the days up to the tenth of January; of later days, each a snapshot, the newest replaces it."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("v"), F.sha2(F.to_date("ts").cast("string"), 256).alias("h"))
    return merge.replace_snapshot(ev.filter("v <= date'2024-01-10'"), ev.filter("v > date'2024-01-10'"), "v", "h").select("event_id")


@entry("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def period_reset(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    return merge.reset_period(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), "y").select("o_orderkey")


@entry("""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderkey % 2 = 1),
m AS (SELECT o_orderpriority, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM b) UNION ALL SELECT o_orderpriority, o_orderkey FROM b WHERE k = 1)
SELECT o_orderpriority, count(*) AS n FROM m GROUP BY 1
""")
def doc_accumulate(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", F.lit(1).alias("n"))
    return merge.accumulate_documents(o.filter("o_orderkey % 2 = 0"), o.filter("o_orderkey % 2 = 1"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderpriority"], "n")[1]


@entry("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'removed' WHEN o_orderkey % 11 = 0 THEN 'added' ELSE 'changed' END AS change
FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0 OR o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0 OR o_orderkey % 5 = 0 AND o_orderkey % 77 <> 0
""")
def change_detect(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    after = o.filter("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "?").otherwise(F.col("o_orderstatus")))
    return merge.changes(o.filter("o_orderkey % 11 <> 0"), after, ["o_orderkey"])


@entry("""
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS levels, min(o_orderdate) AS first_date, max(o_orderdate) AS latest_date FROM orders GROUP BY 1
""")
def cumulative_merge(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", F.array("o_orderpriority").alias("levels"), F.col("o_orderdate").alias("first_date"), F.col("o_orderdate").alias("latest_date"))
    done = merge.merge_sets(o.filter("o_custkey % 2 = 0 or o_custkey % 3 = 0"), o.filter("o_custkey % 2 = 1"), ["o_custkey"], ["levels"], {}, ["first_date"], ["latest_date"])
    return done.select("o_custkey", F.array_join("levels", ",").alias("levels"), "first_date", "latest_date")


# Scalars


@entry("""
SELECT o_orderkey, y - (m < 7)::INT || '-' || y - (m < 7)::INT + 1 AS july, y - (m < 8)::INT || '-' || y - (m < 8)::INT + 1 AS august,
       y - (m < 7 OR m = 7 AND d < 2)::INT || '-' || y - (m < 7 OR m = 7 AND d < 2)::INT + 1 AS second_of_july
FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders)
""")
def school_year_variants(spark, sf_dir):
    d = F.col("o_orderdate")
    return _t(spark, sf_dir, "orders").select("o_orderkey", calendar.school_year(d).alias("july"), calendar.school_year(d, calendar.AUGUST).alias("august"), calendar.school_year(d, calendar.AFTER_FIRST_OF_JULY).alias("second_of_july"))


@entry("""
WITH t AS (SELECT event_id, timezone('Europe/Madrid', ts AT TIME ZONE 'UTC') AS x FROM events), p AS (SELECT event_id, month(x) AS m, hour(x) AS h, isodow(x) AS w, day(x) AS d FROM t)
SELECT event_id, concat_ws(',', CASE WHEN m IN (7, 8) AND w <> 7 AND h IN (9, 12, 15, 18, 21) THEN 'inicio' END, CASE WHEN m NOT IN (7, 8) AND w IN (2, 4) AND h IN (9, 12, 15, 18, 21) THEN 'curso' END,
  CASE WHEN m IN (6, 7) AND h IN (9, 11, 13, 15, 17, 19) THEN 'posiciones' END, CASE WHEN m <> 8 AND w = 5 AND h IN (12, 14, 16, 18, 20) THEN 'acreditaciones' END,
  CASE WHEN (m NOT IN (7, 8) OR m = 7 AND d = 1) AND w IN (1, 3) AND h IN (9, 11, 13, 15, 17, 19) THEN 'puestos' END) AS modes FROM p
""")
def due_modes(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.array_join(calendar.due_modes(F.col("ts").cast("timestamp")), ",").alias("modes"))


@entry(r"SELECT doc_id, trim(regexp_replace(lower(strip_accents(text)), '\s+', ' ', 'g')) AS t FROM documents")
def text_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.folded(F.col("text")).alias("t"))


@entry("SELECT doc_id, trim(regexp_replace(upper(replace(strip_accents(text), 'ß', 'SS')), '[^A-Z0-9]+', ' ', 'g')) AS k FROM documents")
def identity_key(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.identity_key(F.col("text")).alias("k"))


@entry("""
SELECT p_partkey, CASE WHEN t LIKE '%promo%' THEN 'promo' WHEN t LIKE '%o%' THEN 'with o' ELSE '' END AS kind FROM (SELECT p_partkey, lower(p_type) AS t FROM part)
""")
def classify_text(spark, sf_dir):
    t = text.folded(F.col("p_type"))
    return _t(spark, sf_dir, "part").select("p_partkey", classify.first_of([(t.contains("promo"), "promo"), (t.contains("o"), "with o")], "").alias("kind"))


@entry("SELECT event_id, regexp_extract(props, '\"k\":\\s*(-?[0-9]+)', 1) AS k FROM events")
def regex_extract(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.regexp_extract("props", '"k":\\s*(-?[0-9]+)', 1).alias("k"))


@entry("SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events")
def json_extract(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@entry("""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1))), ' ') AS links FROM pages""")
def html_links(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(html.hrefs(F.col("html"))), " ").alias("links"))


@entry(None)
def html_anchor_scan(spark, sf_dir):
    """Links by a real parser: absolute, without fragments, with their texts."""
    return html.page_links(_t(spark, sf_dir, "pages"), "page_id", "url", "html")


@entry(r"SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages")
def url_parts(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")).alias("host"), F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")).alias("path"))


@entry("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents),
c AS (SELECT doc_id, line_no, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS line FROM l),
b AS (SELECT *, sum((length(line) > 200)::INT) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)::BIGINT AS block FROM c WHERE line <> '')
SELECT doc_id, block, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars FROM b WHERE block > 0 GROUP BY 1, 2
""".replace("\\\\", "\\"))
def lines_to_blocks(spark, sf_dir):
    """Lines of texts in blocks that a long line opens."""
    rows = lines.text_lines(_t(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "line_no", F.length("line").alias("n"))
    blocks = windows.blocks_by_start(rows, ["doc_id"], ["line_no"], F.col("n") > 200)  # lengths are shuffled, lines are not
    return blocks.groupBy("doc_id", "block").agg(F.count("*").alias("n_lines"), F.sum("n").alias("n_chars"))


@entry("""
SELECT 'price_positive' AS rule, count(*) FILTER (WHERE NOT coalesce(l_extendedprice > 0, false)) AS violations FROM lineitem UNION ALL
SELECT 'quantity_below_45', count(*) FILTER (WHERE NOT coalesce(l_quantity < 45, false)) FROM lineitem UNION ALL
SELECT 'flag_known', count(*) FILTER (WHERE NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false)) FROM lineitem
""")
def quality_violations(spark, sf_dir):
    rules = {"price_positive": F.col("l_extendedprice") > 0, "quantity_below_45": F.col("l_quantity") < 45, "flag_known": F.col("l_returnflag").isin("A", "N", "R")}
    return quality.report(_t(spark, sf_dir, "lineitem"), "l_orderkey", rules)


@entry("SELECT 'quantity_below_45' AS rule, l_orderkey AS key FROM lineitem WHERE l_quantity >= 45 UNION ALL SELECT 'tax_low', l_orderkey FROM lineitem WHERE l_tax >= 0.07")
def quality_violation_rows(spark, sf_dir):
    return quality.violations(_t(spark, sf_dir, "lineitem"), "l_orderkey", {"quantity_below_45": F.col("l_quantity") < 45, "tax_low": F.col("l_tax") < 0.07})

import json
import random

import pytest
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.operators import aggregates, joins, merge, quality, windows
from rankloom.sources import fetch, html, lines, tables
from rankloom.streaming import incremental


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


def test_occurrence_join_takes_each_once(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), ("z", 11)], "k string, b int")
    assert rows(joins.occurrence_join(a, b, ["k"], ["a"], ["b"]).select("a", "b")) == [(1, 10), (2, None), (3, None)]


def test_fallback_uses_what_is_left(spark):
    a = spark.createDataFrame([(1, "p q", "pq"), (2, "pq", "pq"), (3, "z", "z")], "i int, e string, l string")
    b = spark.createDataFrame([(10, "pq", "pq"), (11, "p  q", "pq")], "j int, e string, l string")
    assert rows(joins.occurrence_join_fallback(a, b, "e", "l", "i", "j", ["i"], ["j"])) == [(1, 11, 2), (2, 10, 1)]


def test_likest_with_margin_against_all_pairs(spark):
    """Names of one, two and more rows, null and empty ones, and ids that several rows have; and no pairs of rows."""
    rng = random.Random(7)
    names = ["large ring", "large rind", "hot bolt", "cold bolt", "old plate", "cold plate", "x", "", None, "élan vital", "elan vital"]
    data = [(i if i % 40 else 40, rng.choice("AB") if i % 50 else None, rng.randrange(25), n and n + rng.choice(["", "", "s", " q"])) for i in range(600) for n in [rng.choice(names)]]
    data += [(1000, "C", 1, ""), (1001, "C", 1, "")]
    df = spark.createDataFrame(data, "a long, brand string, size int, name string")
    other = df.select(F.col("a").alias("b"), "brand", "size", F.col("name").alias("r"))
    longer = F.nullif(F.greatest(F.length("name"), F.length("r")), F.lit(0))
    pairs = df.join(other, ["brand", "size"]).filter("a <> b").select("a", "b", (1 - F.levenshtein("name", "r") / longer).alias("score"))
    for least, margin in ((0.5, 0.05), (0.8, 0.3)):
        got, want = joins.likest_with_margin(df, ["brand", "size"], "a", "name", least, margin), joins.top_with_margin(pairs, "a", "b", "score", least, margin)
        assert rows(got) == rows(want) and got.count() > 10
    many = spark.range(200_000).select("id", F.lit(1).alias("block"), F.concat(F.lit("name "), (F.col("id") % 64).cast("string")).alias("name"))
    assert joins.likest_with_margin(many, ["block"], "id", "name", 0.5, 0.05).count() == 0


def test_fuzzy_against_plain(spark):
    """All pairs of a block, in turns, by difflib; and ids beyond what a double holds."""
    from difflib import SequenceMatcher

    def alike(a, b):
        if a.replace(" ", "") == b.replace(" ", "") or sorted(a.split()) == sorted(b.split()):
            return 1.0
        return SequenceMatcher(None, a, b).ratio()

    rng = random.Random(3)
    names = ["".join(rng.choice("ABCDE ") for _ in range(12)) for _ in range(40)] + ["ANA RUIZ", "RUIZ ANA", "MAR TIN"]
    big = 2**60 + 1
    recs = [(f"b{i % 3}", big + i, n[:-1] + rng.choice("ABX")) for i, n in enumerate(names[:40])] + [("b0", 2, "ANA  RUIZ"), ("b1", 3, "RUIZ ANA"), ("b0", 4, "MARTIN")]
    cand = [(f"b{i % 3}", big + 100 + i, n) for i, n in enumerate(names)]
    got = rows(joins.fuzzy_match(spark.createDataFrame(recs, "b string, i long, k string"), spark.createDataFrame(cand, "b string, j long, r string"), "b", "i", "k", "j", "r", 0.8, 0.05).select("i", "j"))
    free, want = {(b, j): r for b, j, r in cand}, []
    for b, i, k in sorted(recs, key=lambda x: x[1]):
        top = sorted(((alike(k, r), j) for (bb, j), r in free.items() if bb == b), reverse=True)[:2]
        if top and top[0][0] >= 0.8 and top[0][0] - (top[1][0] if len(top) > 1 else 0) >= 0.05:
            want.append((i, top[0][1]))
            del free[(b, top[0][1])]
    assert got == sorted(want) and len(want) > 20 and (4, big + 142) in want


def test_asof_is_strict(spark):
    a = spark.createDataFrame([(1, 5), (2, 4), (3, 1)], "i int, t int").withColumn("k", F.lit(1))
    b = spark.createDataFrame([(4, "x"), (2, "y")], "u int, v string").withColumn("k", F.lit(1))
    assert rows(joins.asof_join(a, b, ["k"], "t", "u", ["v"]).select("i", "v")) == [(1, "x"), (2, "y"), (3, None)]
    assert rows(joins.asof_join(a, b, ["k"], "t", "u", ["v"], strict=False).select("i", "v")) == [(1, "x"), (2, "x"), (3, None)]


def test_guarded_full_outer(spark):
    a = spark.createDataFrame([("k", 1), ("m", 2), ("m", 3)], "k string, a int")
    b = spark.createDataFrame([("k", 4), ("m", 5), ("n", 6)], "k string, b int")
    got = rows(joins.guarded_full_outer(a, b, "k", ["a"], ["b"]).select("k", "a", "b", "source"), "k", "a", "b")
    nulls = joins.guarded_full_outer(a.union(spark.createDataFrame([(None, 7)], a.schema)), b.union(spark.createDataFrame([(None, 8)], b.schema)), "k", ["a"], ["b"])
    assert rows(nulls.filter("k is null").select("a", "b", "source"), "a") == [(None, 8, "right"), (7, None, "left")]
    assert got == [("k", 1, 4, "both"), ("m", None, 5, "right"), ("m", 2, None, "left"), ("m", 3, None, "left"), ("n", None, 6, "right")]


def test_cascade_leaves_ambiguous(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 7), (3, "q", 9)], "i int, e string, r int")
    b = spark.createDataFrame([(10, "x", 5), (11, "y", 6), (12, "y", 7), (13, "z", 9), (14, "w", 9)], "j int, e string, r int")
    assert rows(joins.cascade(a, b, "i", "j", [["e"], ["r"]])) == [(1, 10, 1), (2, 12, 2)]


def test_update_columns_also_to_null(spark):
    base = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, w string, o string")
    new = spark.createDataFrame([(1, None), (9, "z")], "k int, w string")
    assert rows(joins.update_columns(base, new, "k", ["w"])) == [(1, None, "p"), (2, "b", "q")]


def test_ties(spark):
    df = spark.createDataFrame([("k", 5, 1), ("k", 5, 2), ("k", 4, 3)], "k string, v int, s int")
    assert rows(aggregates.argmax_first(df, ["k"], "v", "s", ["s"])) == [("k", 1)]
    assert rows(aggregates.argmax_last(df, ["k"], "v", "s", ["s"])) == [("k", 2)]


def test_credential_sum(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (3, 0), (4, 1)], "o int, c int").withColumn("k", F.lit(1))
    assert [r["s"] for r in windows.running_sum(df, ["k"], ["o"], F.col("c"), "s").orderBy("o").collect()] == [2, 3, None, 4]


def test_ahead_counts(spark):
    refs = spark.createDataFrame([("3A1", 4), ("3A1", 6), ("3A1", 7), ("X", 9)], "code string, o int")
    ev = spark.createDataFrame([("3A1", 4, 0), ("3A1", 6, 2)], "code string, e int, p int")
    got = rows(windows.counts_ahead(refs, ev, ["code"], "o", "e", "p", {"a": 0, "v": 1, "c": 2}))
    assert got == [("3A1", 4, 0, 0, 0), ("3A1", 6, 1, 0, 0), ("3A1", 7, 1, 0, 1), ("X", 9, 0, 0, 0)]


def test_active_rank_against_plain(spark):
    rng = random.Random(1)
    data = [(rng.randint(0, 3), i, rng.random() < 0.5) for i in range(60)]
    got = rows(windows.active_rank(spark.createDataFrame(data, "k int, o int, act boolean"), ["k"], ["o"], F.col("act"), "r").select("o", "r"))
    assert got == sorted((o, 1 + sum(a for k2, o2, a in data if k2 == k and o2 < o)) for k, o, _ in data)


def test_spread_sums_against_windows(spark):
    """A key with most rows, null keys and a plain window over the same rows."""
    rng = random.Random(2)
    data = [(None if i % 17 == 0 else 0 if rng.random() < 0.8 else rng.randint(1, 5), i * 7919 % 6007, rng.random() < 0.5) for i in range(6007)]
    df = spark.createDataFrame(data, "k int, o int, act boolean").repartition(5)
    for a, b in (
        (windows.active_rank(df, ["k"], ["o"], F.col("act"), "r", spread=True), windows.active_rank(df, ["k"], ["o"], F.col("act"), "r")),
        (windows.ordinal(df, ["k"], ["o"], "r", spread=True), windows.ordinal(df, ["k"], ["o"], "r")),
    ):
        got, want = ({(x["k"], x["o"]): x["r"] for x in y.collect()} for y in (a, b))
        assert got == want and len(got) == 6007


def test_blocks_and_gaps(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("xSaSbb")], "i int, c string").withColumn("k", F.lit(1))
    assert rows(windows.blocks_by_start(df, ["k"], ["i"], F.col("c") == "S").select("i", "block")) == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)]
    assert rows(windows.blocks_by_end(df, ["k"], ["i"], F.col("c") == "S").select("i", "block")) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2)]
    pos = spark.createDataFrame([(1, 1), (1, 3), (2, 1), (2, 2)], "k int, p int")
    assert rows(windows.gaps(pos, ["k"], "p")) == [(1, 3, 2)] and [r["k"] for r in windows.incomplete(pos, ["k"], "p").collect()] == [1]


def test_places_over_many_partitions(spark):
    df = spark.createDataFrame([(i * 7 % 101, None if i % 10 == 0 else i) for i in range(101)], "a int, b int").repartition(7)
    got = windows.text_order(df, [F.col("b"), F.col("a")]).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 102)) and [r["b"] for r in got[-11:]] == [None] * 11 and [r["b"] for r in got[:3]] == [1, 2, 3]


def test_places_of_many_wide_rows(spark):
    """Ranges that adaptive plans merge in different ways for narrow and wide rows."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(500_000).select((F.col("id") * 7919 % 500_000).alias("a"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("wide"))
        got = windows.text_order(df, [F.col("a")]).agg(F.count("*"), F.count_distinct("place"), F.min("place"), F.max("place"), F.count_if(F.col("place") != F.col("a") + 1)).first()
        assert tuple(got) == (500_000, 500_000, 1, 500_000, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_or_else(spark):
    a, b = spark.range(2), spark.range(5, 7)
    assert rows(windows.or_else(a, b)) == [(0,), (1,)] and rows(windows.or_else(a.limit(0), b)) == [(5,), (6,)]


STATE = "k string, d string, v int"


def test_dated_upsert(spark):
    state = spark.createDataFrame([("a", "2026-02-02", 1), ("b", "2026-02-02", 1)], STATE)
    batch = spark.createDataFrame([("a", "2026-02-01", 2), ("b", "2026-02-02", 2), ("c", "2026-01-01", 2)], STATE)
    once = merge.dated_upsert(state, batch, ["k"], "d", ["v"])
    assert rows(once) == [("a", "2026-02-02", 1), ("b", "2026-02-02", 2), ("c", "2026-01-01", 2)] == rows(merge.dated_upsert(once, batch, ["k"], "d", ["v"]))
    assert rows(merge.upsert(state, batch, ["k"], ["d"]).select("k", "v")) == [("a", 2), ("b", 2), ("c", 2)]


def test_replace(spark):
    state, batch = spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], STATE), spark.createDataFrame([("a", "2", 2)], STATE)
    assert rows(merge.replace_partitions(state, batch, "k")) == [("a", "2", 2), ("b", "1", 1)]
    snap = lambda d, h: spark.createDataFrame([("n", d, h)], "k string, d string, h string")
    now = snap("2026-02", "h1")
    for new, want in ((snap("2026-03", "h2"), "h2"), (snap("2026-01", "h2"), "h1"), (snap("2026-03", "h1"), "h1"), (snap("2026-03", "h2").limit(0), "h1")):
        assert [r["h"] for r in merge.replace_snapshot(now, new, "d", "h").collect()] == [want]
    assert merge.replace_snapshot(now.limit(0), now, "d", "h").count() == 1
    assert rows(merge.reset_period(state, batch, "d")) == [] and len(rows(merge.reset_period(state, batch.limit(0), "d"))) == 2
    assert rows(merge.seeded(batch, state, ["k"])) == [("a", "2", 2), ("b", "1", 1)]


def test_documents_accumulate(spark):
    docs = spark.createDataFrame([("u1", "2026-01", "s", 3), ("u2", "2026-01", "s", 1)], "url string, d string, code string, n int")
    fix = spark.createDataFrame([("u1", "2026-02", "s", 1), ("u1", "2026-02", "t", 1), ("u1", "2026-01", "s", 9)], docs.schema)
    merged, totals = merge.accumulate_documents(docs, fix, "url", ["d"], ["code"], "n")
    assert rows(totals) == [("s", 2), ("t", 1)]
    again, totals2 = merge.accumulate_documents(merged, fix, "url", ["d"], ["code"], "n")
    assert rows(totals2) == rows(totals) and merge.changes(merged, again, ["url", "code"]).count() == 0


def test_set_merge_is_idempotent(spark):
    s = "k string, levels array<string>, top string, first string, last string"
    state = spark.createDataFrame([("a", ["B2"], "B2", "2026-01", "2026-01")], s)
    batch = spark.createDataFrame([("a", ["C1"], "C1", "2025-12", "2026-02"), ("b", ["B2"], "B2", "x", "x")], s)
    once = merge.merge_sets(state, batch, ["k"], ["levels"], {"top": {"B2": 2, "C1": 3, "C2": 4}}, ["first"], ["last"])
    assert rows(once) == [("a", ["B2", "C1"], "C1", "2025-12", "2026-02"), ("b", ["B2"], "B2", "x", "x")]
    assert merge.changes(once, merge.merge_sets(once, batch, ["k"], ["levels"], {"top": {"B2": 2, "C1": 3, "C2": 4}}, ["first"], ["last"]), ["k"]).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([(1, 5, 4, None), (2, 3, 3, 4), (3, None, None, 2)], "k int, w int, a int, aw int")
    rules = quality.rank_rules("w", "w", "a", "aw")
    assert rows(quality.violations(df, "k", rules)) == [("after_without_not_above_after", 2), ("no_after_without_alone", 3), ("without_follows_after", 1), ("without_follows_after", 2)]
    with pytest.raises(Exception, match="rule broken"):
        quality.gated(df, rules).count()
    assert quality.gated(df, {"k": F.col("k") > 0}).count() == 3
    with pytest.raises(Exception, match="fewer than"):
        quality.least_rows(df, 10, "rows").collect()


def test_cut_rows_of_all_ages(spark):
    base = ["12000251", "219", "95", "TEC", "CENTRO", "MUNI", "secundaria"]
    forms = [base, [*base, "inicio"], [*base, "vacante", "curso"], [*base, "vacante", "true"], [*base, "vacante", "true", "false"], [*base, "vacante", "false", "true", "7"], [*base, "vacante", "inicio", "true", "false", "9"]]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, r array<string>")
    got = [tuple(r)[7:] for r in schemas.upgraded_cuts(df.orderBy("i"), "r", F.lit("curso")).collect()]
    assert got == [("", "curso", False, False, None), ("", "inicio", False, False, None), ("vacante", "curso", False, False, None), ("vacante", "curso", True, False, None), ("vacante", "curso", True, False, None), ("vacante", "curso", False, True, 7), ("vacante", "inicio", True, False, 9)]


def test_links(spark):
    page = "<a href='/a.pdf#x'>One <b>two</b></a> <a href=\"http://h/a.pdf\">again</a><a>none</a><a href='b'>B"
    df = spark.createDataFrame([(1, "http://h/dir/p", page), (2, "http://h", None)], "page_id int, url string, html string")
    assert rows(html.page_links(df, "page_id", "url", "html")) == [(1, 0, "http://h/a.pdf", "One two")]  # the last is never closed
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d")], "url string, target string")
    assert rows(html.crawl(edges, spark.createDataFrame([("a",)], "url string"))) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    assert html.crawl(edges, spark.createDataFrame([("a",)], "url string"), 2).count() == 2


def test_layout(spark):
    chars = [(1, i, c, 10.0 + i, 5.04 if i < 2 else 9.0) for i, c in enumerate("ab c")]
    df = spark.createDataFrame(chars, "page int, seq int, ch string, x0 double, top double")
    assert rows(lines.layout_lines(df, ["page"]).select("top", "line")) == [(5.0, "ab"), (9.0, "c")]
    assert rows(lines.box_text(df, ["page"], 10, 11, 0, 10)) == [(1, "ab")]
    words = spark.createDataFrame([(1, "7", 10.0, 5.0, 100.0), (1, "8", 50.0, 5.0, 100.0), (1, "9", 10.0, 95.0, 100.0), (1, "7", 10.0, 9.0, 100.0)], "page int, text string, x0 double, top double, page_height double")
    assert rows(lines.row_markers(words, ["page"])) == [(1, "7", 5.0)]
    script = spark.createDataFrame([('const NAMES = {\n "a1": "Uno",\n b2: "Dos"\n};',)], "t string")
    assert rows(lines.literal_map(script, "t", "NAMES")) == [("a1", "Uno"), ("b2", "Dos")]


def test_accreditations(spark):
    table = [["Apellido1", "Apellido2", "Nombre", "Idioma", "Nivel", "Motivos Exclusión"], ["UNO", "DOS", "ANA", "Inglés", "b2", ""], ["TRES", None, "EVA", "Francés", "B2", ""], ["SEIS", "", "IU", "Anglès", "C1", "x"], ["OCHO", "", "PAU", "Anglès", "A2", ""]]
    df = spark.createDataFrame([(table,)], "t array<array<string>>")
    assert rows(lines.accreditation_rows(df, "t")) == [("UNO DOS, ANA", "B2")]
    # The header may follow a title, its cells may say more, a level may be punctuated; short rows and tables without a header give nothing.
    other = [["Llistat"], ["1. Apellido1", "Nombre / Nom", "Idioma", "Nivel", "Apellido2"], ["NEU", "IVO\nJAN", "English", "C-1.", "RIU"], ["", "EVA", "Anglès", "C2", "SOL"], ["CURT", "X"], ["", "SENSE", "Anglès", "C2", ""]]
    more = spark.createDataFrame([(other,), ([["Nombre"], ["x"]],), ([],), (None,)], "t array<array<string>>")
    assert rows(lines.accreditation_rows(more, "t")) == [("NEU RIU, IVO JAN", "C1"), ("SOL, EVA", "C2")]


def test_cell_grid_gives_back_the_table(spark):
    """Boxes of a table's words, in any order, form the arrays that accreditation rows are read from."""
    table = [["Apellido1", "Apellido2", "Nombre", "Idioma", "Nivel"], ["UNO", "DEL RIO", "ANA MARIA", "Inglés", "B2"], ["TRES", "", "EVA", "Anglès", "C1"], ["", "", "", "Francés", "C1"]]
    words = [(p, w, 40.0 + 110 * j + 40 * k, 40.0 + 110 * j + 40 * k + 5 * len(w), 50.0 + 14 * i + 0.5 * (j % 3)) for p in (1, 2) for i, row in enumerate(table) for j, cell in enumerate(row) for k, w in enumerate(cell.split())]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame(words, "page int, text string, x0 double, x1 double, top double").repartition(3)
    grid = lines.cell_grid(df, ["page"], column_gap=20)
    assert [[list(r) for r in x["cells"]] for x in grid.orderBy("page").collect()] == [table, table]
    assert rows(lines.accreditation_rows(grid, "cells").distinct()) == [("TRES, EVA", "C1"), ("UNO DEL RIO, ANA MARIA", "B2")]
    assert lines.cell_grid(df.limit(0), ["page"]).count() == 0


def test_envelope_written_in_parts(spark, tmp_path):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("k"), "id", F.when(F.col("id") % 7 != 0, F.concat(F.lit('q"ü,'), "id")).alias("v")).repartition(5)
    path = str(tmp_path / "out.json")
    for _ in range(2):  # a second run replaces the file
        tables.write_envelope(df, path, "fields", "items", ["k", F.col("id").desc()], {"v": 1})
    got = json.load(open(path, encoding="utf-8"))
    assert got["v"] == 1 and got["fields"] == ["k", "id", "v"]
    assert got["items"] == sorted(([r["k"], r["id"], r["v"]] for r in df.collect()), key=lambda r: (r[0], -r[1]))
    tables.write_envelope(df.limit(0), path, "fields", "items", ["k"])
    assert json.load(open(path))["items"] == [] and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.json"]


def test_crawl_hands_labels_down_in_the_order_of_a_queue(spark):
    from collections import deque

    rng = random.Random(5)
    links = [(f"p{i}", j, f"p{rng.randrange(40)}" if rng.random() < 0.6 else f"d{rng.randrange(60)}", rng.choice(["", "", "north", "south"])) for i in range(40) for j in range(rng.randint(0, 5))]
    pending, seen, docs = deque([("p0", None)]), {}, []
    while pending and len(seen) < 12:
        page, label = pending.popleft()
        if page in seen:
            continue
        seen[page] = (len(seen) + 1, label)
        for p, place, url, text in sorted(x for x in links if x[0] == page):
            own = text or label
            if url.startswith("p"):
                pending.append((url, own))
            elif own:
                docs.append((p, place, url, text, own))
    df = spark.createDataFrame(links, "page string, place int, url string, text string")
    label = F.nullif(F.col("text"), F.lit(""))
    pages, found = html.crawl_documents(df, spark.createDataFrame([("p0",)], "url string"), label, F.col("url").startswith("p"), F.col("url").startswith("d"), 12)
    assert {r["url"]: (r["nth"], r["label"]) for r in pages.collect()} == seen
    assert sorted(map(tuple, found.collect()), key=str) == sorted(docs, key=str) and len(docs) > 3


def test_files(spark, tmp_path):
    rows_ = {"fields": ["code", "n"], "items": [["007", 1], ["08", None], ["x"]]}
    for name in ("t.json", "t.json.gz"):
        path = str(tmp_path / name)
        tables.write_json_atomically(path, rows_)
        assert tables.read_json(path) == rows_
        assert rows(tables.read_envelope(spark, path, "fields", "items", "code string, n int")) == [("007", 1), ("08", None), ("x", None)]
    assert tables.read_json(str(tmp_path / "none.json"), {"a": []}) == {"a": []}
    (tmp_path / "c.csv").write_text("codcen,lat\n03000001,0.5\n", encoding="utf-8")
    assert rows(tables.read_csv(spark, str(tmp_path / "c.csv"), ["codcen", "mail", "lat"])) == [("03000001", None, "0.5")]
    df = spark.createDataFrame([("b", 2.5, None), ("a", 1.0, "q}\"")], "k string, v double, t string")
    import json

    assert json.loads(tables.envelope(df, "fields", "items", ["k"], {"v": 1}).first()["value"]) == {"v": 1, "fields": ["k", "v", "t"], "items": [["a", 1.0, "q}\""], ["b", 2.5, None]]}
    tables.write_flags(str(tmp_path / "f"), {"a": True, "b": 2})
    assert (tmp_path / "f").read_text() == "a=true\nb=2\n"


def test_retry():
    class Clock:
        now, seen = 0.0, []

    def request(timeout):
        Clock.seen.append(timeout)
        Clock.now += timeout
        raise OSError("no")

    with pytest.raises(OSError):
        fetch.fetch_within(request, 20, 2, 5, 1, lambda: Clock.now, lambda s: setattr(Clock, "now", Clock.now + s))
    assert Clock.seen[:3] == [2, 5, 5]
    tries = []

    def gone(timeout):
        tries.append(timeout)
        raise fetch.HttpStatus(404)

    with pytest.raises(fetch.HttpStatus):
        fetch.fetch_times(gone, pause=lambda s: None)
    assert len(tries) == 1


def test_stream_keeps_state(spark, tmp_path):
    schema = "k string, d string, v int"
    spark.createDataFrame([("a", "2", 1), ("b", "1", 1)], schema).write.json(str(tmp_path / "in"))
    empty = spark.createDataFrame([], schema)
    run = lambda: incremental.keep_merged(spark.readStream.schema(schema).json(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "ck"), lambda s, b: merge.dated_upsert(s, b, ["k"], "d", ["v"]), empty).awaitTermination(60)
    run()
    spark.createDataFrame([("a", "1", 9), ("b", "2", 9)], schema).write.mode("append").json(str(tmp_path / "in"))
    run()
    run()
    assert rows(incremental.current(spark, str(tmp_path / "state"), empty)) == [("a", "2", 1), ("b", "2", 9)]


def test_index_finds_every_alike_pair(spark):
    """All pairs by difflib, over floors, lengths, repeated letters, letters of several bytes and hot names."""
    from difflib import SequenceMatcher

    from rankloom.operators import likeness
    from rankloom.scratch import Scratch

    rng = random.Random(8)
    base = ["".join(rng.choice("ABCDÑ ") for _ in range(rng.randint(1, 30))) for _ in range(40)] + ["A", "AA", "AAAAAAAA", "ABABABABAB", "x" * 230, ""]
    change = lambda n: "".join(rng.choice([c, c, c, c, c, c, c, c, "", c + "B", "Z"]) for c in n)
    left, right = {n for n in base}, {change(n) for n in base for _ in range(3)} | set(base)
    names = spark.createDataFrame([(0, "b", n) for n in left] + [(1, "b", n) for n in right] + [(1, "other", n) for n in left], "side int, b string, name string")
    classes = Scratch(spark, "test-index").table(names.withColumn("c", F.monotonically_increasing_id()))
    name_of = {r["c"]: r["name"] for r in classes.collect()}
    for floor in (0.5, 0.78, 0.87):
        got = {(name_of[r["i"]], name_of[r["j"]]): r["score"] for r in likeness.alike(Scratch(spark, "test-index"), classes, floor).collect()}
        for a in left:
            for z in right:
                same = a.replace(" ", "") == z.replace(" ", "") or " ".join(sorted(a.split())) == " ".join(sorted(z.split()))
                score = 1.0 if same else SequenceMatcher(None, a, z).ratio()
                assert got.get((a, z)) == (score if score >= floor else None), (a, z, floor)


def test_index_compares_few_of_all_pairs(spark):
    from rankloom.operators import likeness
    from rankloom.scratch import Scratch

    rng = random.Random(4)
    parts = ["".join(rng.choice("ABCDEFGHILMNOPRSTUVZ") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    names = list({" ".join(rng.choice(parts) for _ in range(3)) for _ in range(2000)})
    df = spark.createDataFrame([(s, "b", n if s else n[:5] + "X" + n[6:]) for n in names for s in (0, 1)], "side int, b string, name string").distinct()
    scratch = Scratch(spark, "test-index")
    classes = scratch.table(df.withColumn("c", F.monotonically_increasing_id()))
    assert len(names) <= likeness.candidate_pairs(scratch, classes, 0.87).count() + 20 < 5 * len(names)


def test_copies_stand_in_the_way_and_components_take_turns_apart(spark):
    recs = [("b", i, "ANA MARIA RUIZ PEREZ") for i in range(300)] + [("b", 900, "LUISA GARCIA MORENO"), (None, 901, "X"), ("b", 902, None)]
    cand = [("b", 1000 + i, "ANA MARIA RUIZ PEREZ") for i in range(200)] + [("b", 5000, "LUISA GARCIA MORENOS"), ("b", 5001, None)]
    frame = lambda rows, k, i: spark.createDataFrame(rows, f"b string, {i} long, {k} string")
    match = lambda c: rows(joins.fuzzy_match(frame(recs, "k", "i"), frame(c, "r", "j"), "b", "i", "k", "j", "r").select("i", "j"))
    assert match(cand) == [(900, 5000)]
    assert match([("b", 7, "ANA MARIA RUIZ PEREZ")]) == [(0, 7)]
    assert match([]) == []

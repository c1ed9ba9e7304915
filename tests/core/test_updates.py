"""Pipelines, gates and sources on small tables."""

import pytest
from pyspark.sql import functions as F

from rankloom import schemas
from rankloom.functions import ranks
from rankloom.operators import aggregates, joins, merge, quality, windows
from rankloom.pipelines import accreditations, cuts, offers, positions
from rankloom.sources import cache, centres, fetch, html


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


AWARDS = "url string, sha256 string, published_date string, seq long, " + schemas.AWARDS


def award(url, date, cut, centre="46000001", code="126", body="maestros", name="A, B", seq=0, sha=None, kind="vacante"):
    return (url, sha or f"sha-{url}", date, seq, cut, name, centre, code, "SPEC", "CENTRE X", "VILA (LA)", body, kind, False, "C", False)


def awards(spark, *data):
    return spark.createDataFrame(list(data), AWARDS)


def guide(spark):
    return spark.createDataFrame([("46000001", "CEIP Guide", "València")], "code string, name string, municipality string")


STATE = "center_code string, specialty_code string, cut int, specialty_name string, center_name string, municipality string, body string, placement_type string, english_requirement boolean, itinerant boolean, origin string, school_year string, published_date string, url string"


def test_document_cuts_keep_the_first_of_equals(spark):
    a = awards(spark, award("u", "2026-07-20", 5, seq=1, name="F, IRST"), award("u", "2026-07-20", 5, seq=2, kind="x"), award("u", "2026-07-20", 3, seq=3), award("u", "2026-07-20", 9, code="3A1", seq=4), award("u", "2026-07-20", 2, centre="03000009", seq=5))
    got = rows(cuts.document_cuts(a, guide(spark)).select("center_code", "cut", "center_name", "municipality", "placement_type", "school_year"))
    assert got == [("03000009", 2, "Centre X", "La Vila", "vacante", "2026-2027"), ("46000001", 5, "CEIP Guide", "València", "vacante", "2026-2027")]
    assert cuts.assignments(awards(spark, award("u", "d", 5, seq=1), award("u", "d", 5, seq=2, name="a, b"), award("u", "d", 6, seq=3))).count() == 2


def test_start_then_course(spark):
    def run(*args):
        """State is kept as rows between runs, as users keep it."""
        return {k: spark.createDataFrame(v.collect(), v.schema) for k, v in cuts.run(*args).items() if k != "vacancies"}

    empty = spark.createDataFrame([], STATE)
    ledger = spark.createDataFrame([], merge.LEDGER)
    first = awards(spark, award("m1", "2026-07-20", 5), award("s1", "2026-07-21", 7, code="3A1", body="secundaria"))
    out = run(empty, empty, ledger, first, guide(spark), "inicio")
    assert rows(out["start"].select("specialty_code", "cut", "origin")) == [("126", 5, "inicio"), ("3A1", 7, "inicio")]
    assert {r["url"] for r in out["ledger"].collect()} == {"m1", "s1"}
    # A corrected document of one body replaces that body's rows only; the same content under another url is left out.
    again = awards(spark, award("m2", "2026-07-22", 4), award("m3", "2026-07-23", 9, sha="sha-s1", code="3A1", body="secundaria"))
    second = run(out["start"], out["course"], out["ledger"], again, guide(spark), "inicio")
    assert rows(second["start"].select("specialty_code", "cut")) == [("126", 4), ("3A1", 7)]
    # The course begins from the start's rows, its own win, and the newest document wins among them.
    course = awards(spark, award("c1", "2026-10-01", 6), award("c2", "2026-10-08", 2), award("c2", "2026-10-08", 1, centre="03000009"))
    third = run(second["start"], second["course"], second["ledger"], course, guide(spark), "curso")
    assert rows(third["course"].select("center_code", "specialty_code", "cut", "origin")) == [("03000009", "126", 1, "curso"), ("46000001", "126", 2, "curso"), ("46000001", "3A1", 7, "inicio")]
    # A new school year empties both; the course holds the start's rows until it has documents of its own.
    new = run(third["start"], third["course"], third["ledger"], awards(spark, award("n1", "2027-07-20", 8)), guide(spark), "inicio")
    assert rows(new["start"].select("cut", "school_year")) == [(8, "2027-2028")]
    assert rows(new["course"].select("cut", "school_year", "origin")) == [(8, "2027-2028", "inicio")]
    # While it has none it follows corrections of the start; once it has, it stays as it is.
    assert rows(out["course"].select("cut", "origin")) == [(5, "inicio"), (7, "inicio")] and rows(second["course"].select("cut")) == [(4,), (7,)]
    fourth = run(third["start"], third["course"], third["ledger"], awards(spark, award("m9", "2026-10-20", 1)), guide(spark), "inicio")
    assert rows(fourth["course"].select("center_code", "cut")) == rows(third["course"].select("center_code", "cut"))
    late = cuts.apply_course(third["course"], new["start"], cuts.document_cuts(awards(spark, award("n2", "2027-10-01", 3, centre="03000009")), guide(spark)))
    assert rows(late.select("center_code", "cut", "origin")) == [("03000009", 3, "curso"), ("46000001", 8, "inicio")]


def test_vacancies(spark):
    a = awards(spark, award("u", "d", 1), award("u", "d", 2), award("u", "d", 3, code="3A1"), award("u", "d", 4, kind=""))
    row = cuts.document_vacancies(a).first()
    assert (row["records"], row["counted"], row["excluded"], row["owned"], row["counts"]) == (4, 3, 1, 2, {"126": 2})


@pytest.mark.parametrize(("url", "text", "out"), [("http://x/260720_list.pdf", "", False), ("http://x/250720_list.pdf", "", True), ("http://x/a.pdf", "curso 2024/2025", True), ("http://x/a%202027.pdf", "", False), ("http://x/a.pdf", "no year", False)])
def test_links_of_other_years(spark, url, text, out):
    assert spark.range(1).select(cuts.outside_year(F.lit(url), F.lit(text), F.lit("2026-2027")).alias("o")).first()["o"] is out


def test_profiles(spark):
    p = spark.createDataFrame([(1, "RUIZ, ANA", "126", "m", 5), (2, "RUIZ, ANA", "126", "m", 9), (3, "DE LA O, EVA", "126", "m", None), (4, "SOLO, UNO", "126", "m", 7), (5, "DOS, X", "3A1", "m", None), (6, "DOS, X", "3A1", "m", None)], "profile int, official_name string, specialty_code string, body string, after_order int")
    a = spark.createDataFrame([(10, "Ruiz, Ana", "126", "m", 9), (11, "De Lao, Eva", "126", "m", 40), (12, "Other, Name", "126", "m", 7), (13, "Dos, X", "3A1", "m", 1), (14, "Ruiz, Ana", "126", "m", 50), (15, "Ruiz, Ana", "126", "s", 9)], "id int, candidate_name string, specialty_code string, body string, cut int")
    before = spark.createDataFrame([(6, "DOS, X", "3A1"), (2, "RUIZ ANA", "126")], "profile int, candidate_name string, specialty_code string")
    assert rows(positions.resolve_profiles(a, p, before, "inicio")) == [(10, 2, "exact"), (11, 3, "unranked"), (12, 4, "ranked")]
    assert rows(positions.resolve_profiles(a, p, before, "curso")) == [(10, 2, "exact"), (11, 3, "only"), (13, 6, "repeated"), (14, 2, "repeated")]


def test_double_credential_counts_twice(spark):
    data = [(0, "A, A", "126", 1, True), (0, "A, A", "121", 1, True), (1, "B, B", "126", 2, True), (2, "C, C", "126", 3, True), (3, "D, D", "126", None, True), (4, "E, E", "126", 4, False), (5, "F, F", "122", 5, True)]
    df = spark.createDataFrame(data, "person_index int, official_name string, specialty_code string, after int, masters boolean")
    acc = spark.createDataFrame([("a a",), ("C, C",), ("D, D",), ("E, E",), ("F, F",)], "official_name string")
    out = positions.english_positions(df, acc)
    assert rows(out.filter("specialty_code = '126'").select("person_index", "english_position")) == [(0, 2), (1, None), (2, 3), (3, None), (4, None)]
    assert rows(out.filter("specialty_code <> '126'").select("english_position")) == [(None,), (None,)]
    assert rows(positions.english_totals(out)) == [("126", 3)]


def test_accreditations(spark):
    state = spark.createDataFrame([], accreditations.STATE)
    r = spark.createDataFrame([("RUIZ, ANA", "B2", "Valencia", "u1", "2026-02-01"), ("Ruiz,  Ana", "C1", "Alicante", "u2", "2026-01-01")], "official_name string, level string, province string, source_url string, date string")
    pos = spark.createDataFrame([(0, "RUIZ, ANA", "126", 1, True)], "person_index int, official_name string, specialty_code string, after int, masters boolean")
    out = accreditations.run(state, r, pos)
    row = accreditations.published(out["state"]).first()
    assert (row["display_name"], row["highest_level"], row["levels"], row["provinces"], row["first_date"], row["latest_date"]) == ("Ana Ruiz", "C1", ["B2", "C1"], ["Alicante", "Valencia"], "2026-01-01", "2026-02-01")
    assert rows(out["changes"].select("change")) == [("added",)] and rows(out["positions"].select("english_position")) == [(1,)]
    assert accreditations.run(out["state"], r, pos)["changes"].count() == 0


def payload(spark, *data):
    """(year, date, sha, items)"""
    n = schemas.names_of(schemas.OFFERS)
    item = lambda order, code="46000001", kind="vacante": [str(order), "maestros", "126", "V", "M", code, "C", "1", "", "false", "false", "", kind]
    return spark.createDataFrame([(quality.OFFER_DATASET, quality.OFFER_MODE, y, quality.OFFER_STATUS, d, n, [item(*i) for i in items], h) for y, d, h, items in data], "dataset string, update_mode string, academic_year string, status string, publication_date string, item_fields array<string>, items array<array<string>>, sha256 string")


def test_offers(spark):
    good = payload(spark, ("2026-2027", "2026-09-01", "h1", [(1,), (2,)]))
    state = offers.item_rows(good.limit(0))
    one = offers.update(state, good, "2026-2027")
    assert rows(one.select("offer_order")) == [(1,), (2,)]
    # Older ones, those of another year and invalid ones change nothing.
    other = payload(spark, ("2026-2027", "2026-08-01", "h0", [(3,)]), ("2025-2026", "2026-09-09", "h2", [(4,)]), ("2026-2027", "2026-10-01", "h3", [(1,), (1,)]), ("2026-2027", "2026-10-02", "h4", [(1, "x")]), ("2026-2027", "soon", "h5", [(1,)]))
    assert rows(offers.update(one, other, "2026-2027").select("offer_order")) == [(1,), (2,)]
    assert rows(offers.broken_payloads(other, "2026-2027"), "key", "rule") == [("year", "h2"), ("distinct_orders", "h3"), ("centre_codes", "h4"), ("date", "h5")]
    newer = payload(spark, ("2026-2027", "2026-09-02", "h6", [(7,)]))
    assert rows(offers.update(one, newer, "2026-2027").select("offer_order")) == [(7,)]
    # A new year without a document clears the snapshot; no document in the same year keeps it.
    assert offers.update(one, other.limit(0), "2027-2028").count() == 0
    assert offers.update(one, other.limit(0), "2026-2027").count() == 2


def test_publish_rule(spark):
    case = lambda *x: spark.range(1).select(merge.should_publish(*map(F.lit, x)).alias("p")).first()["p"]
    assert case("a", "b", "2026-01-01", "2026-01-02", "y", "y") and case("a", "b", "2026-01-02", "2026-01-02", "y", "y") and case(None, "b", None, "2026-01-02", "y", "y")
    assert not case("a", "a", "2026-01-01", "2026-01-02", "y", "z") and not case("a", "b", "2026-01-03", "2026-01-02", "y", "y") and case("a", "b", "2026-01-03", "2026-01-02", "y", "z")


def test_periods_and_first_in_group(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "a", "y"), (4, "b", None)], "i int, k string, v string")
    own, rest = merge.of_period(df, F.col("v"), "x")
    assert [r["i"] for r in own.collect()] == [2] and sorted(r["i"] for r in rest.collect()) == [1, 3, 4]
    assert rows(windows.first_in_group(df, ["k"], ["i"], "v", "f").select("i", "f")) == [(1, "x"), (2, "x"), (3, "x"), (4, None)]


def test_overrides(spark):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "code string, name string")
    new = spark.createDataFrame([("2", "c"), ("3", None)], "code string, name string")
    assert rows(joins.override_rows(base, new, "code")) == [("1", "a"), ("2", "c"), ("3", None)]
    row = ["x"] * 14 + ["39.5", "nan"]
    broken = quality.violations(spark.createDataFrame([("k", row), ("g", row[:15] + ["1"]), ("s", ["x"])], "code string, r array<string>"), "code", quality.override_rules("r", 16))
    assert rows(broken) == [("arity", "s"), ("coordinates", "k"), ("coordinates", "s")]
    assert rows(quality.repeated_keys(spark.createDataFrame([("a",), ("a ",), ("",), ("b",)], "c string"), "c")) == [("key_once", ""), ("key_once", "a")]
    sites = spark.createDataFrame([("46000001", "https://a.es"), ("46000002", "ftp://a.es"), ("46000003", "http://"), ("4", "http://a"), ("46000005", None)], "code string, url string")
    blocked = spark.createDataFrame([("46000001", "x"), ("46000009", " ")], "code string, reason string")
    assert rows(quality.web_override_violations(sites, blocked)) == [("code", "4"), ("mapped_and_blocked", "46000001"), ("reason", "46000009"), ("url", "46000002"), ("url", "46000003"), ("url", "46000005")]


def test_gates(spark):
    table = spark.createDataFrame([(3, 5, {"maestros": "m", "secundaria": "s"}, list(quality.CUT_FIELDS)), (2, 4, {"maestros": "x"}, ["cuerpo"])], "schema_version int, policy_version int, pdfs map<string,string>, cut_format array<string>")
    assert rows(quality.violations(table, "schema_version", quality.cut_table_rules({"maestros": "m", "secundaria": "s"}))) == [("fields", 2), ("pdf_maestros", 2), ("pdf_secundaria", 2), ("policy", 2), ("schema", 2)]
    found = spark.createDataFrame([("A", "128", 1, None), ("A", "127", 2, 2)], "name string, code string, a int, b int")
    expected = spark.createDataFrame([("A", "128", None), ("A", "127", 2), ("B", "1", 1)], "name string, code string, b int")
    assert rows(quality.control_examples(found, expected, "name")) == [("control_example", "B")]
    bytes_ = spark.createDataFrame([(bytearray(b"%PDF-1.7 x"),), (bytearray(b" \n%PDF-"),), (bytearray(b"<html>"),), (None,), (bytearray(b""),)], "c binary").select(quality.is_pdf(F.col("c")).alias("p"))
    assert [r["p"] for r in bytes_.collect()] == [True, True, False, False, False]
    with pytest.raises(Exception, match="ambiguous: k"):
        quality.unambiguous(spark.createDataFrame([("k", 1), ("k", 2)], "k string, v int"), ["k"], "v").collect()
    assert rows(quality.unambiguous(spark.createDataFrame([("k", 1), ("k", 1)], "k string, v int"), ["k"], "v")) == [("k", 1)]
    with pytest.raises(Exception, match="rule broken: positive"):
        quality.gated(spark.createDataFrame([(0,)], "v int"), {"positive": F.col("v") > 0}).collect()


def test_rank_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    null = F.lit(None).cast("int")
    assert one(ranks.compatible_rank(null, F.lit(3))) == 3 and one(ranks.compatible_rank(F.lit(2), F.lit(3))) == 2
    assert one(ranks.effective_disabled(F.lit(True), F.lit(False), F.lit(True))) is False and one(ranks.effective_disabled(F.lit(None).cast("boolean"), F.lit(False), F.lit(True))) is True
    assert one(ranks.last_digits(F.lit("a12-3456 789"))) == "456789" and one(ranks.last_digits(F.lit("12345"))) is None
    assert [one(ranks.positive_integer(F.lit(x))) for x in (" 7 ", "0", "-1", "x")] == [7, None, None, None]
    assert [one(ranks.finite(F.lit(x).cast("double"))) for x in ("1", "NaN", "Infinity", None)] == [True, False, False, False]


def test_reasons_and_rebuilds(spark):
    df = spark.createDataFrame([("m", "b", "r", 1), ("m", "b", "r", 1), ("m", "b", "r", 2), ("m", "b", "q", 1)], "mode string, body string, reason string, batch int")
    assert rows(aggregates.reason_counts(df, ["mode", "body"], "reason", "batch")) == [("m:b:q", 1), ("m:b:r", 1)]
    state, new = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(2,)], "v int")
    prints = lambda *x: spark.createDataFrame(list(x), "name string, sha256 string")
    for old, now, want in ((prints(("a", "1")), prints(("a", "1")), 1), (prints(("a", "1")), prints(("a", "2")), 2), (prints(("a", "1")), prints(("a", "1"), ("b", "1")), 2), (prints(("a", "1"), ("b", "1")), prints(("a", "1")), 1)):
        assert rows(merge.rebuilt_if_changed(state, new, old, now)) == [(want,)]
    assert rows(merge.key_union(state, new, "v")) == [(1,), (2,)]


def test_cache_by_digest(spark, tmp_path):
    calls = []
    compute = lambda: calls.append(1) or spark.range(3)
    for digests in (["a", "b"], ["a", "b"], ["ab"], ["a", "c"]):
        assert cache.cached(spark, str(tmp_path), digests, compute).count() == 3
    assert len(calls) == 3


def test_centres(spark):
    base = dict.fromkeys(centres.COLUMNS)
    data = [
        {**base, "codcen": "46000001", "cod_estado": "a", "dlibre": "JAUME I", "dgenerica_cas": "INSTITUTO DE EDUCACIÓN SECUNDARIA", "noms_mun": "VALENCIA", "localidad_oficial": "X", "telef": "0", "web": " w ", "latitud": "39.5", "longitud": ""},
        {**base, "codcen": "03000002", "cod_estado": "L", "dlibre": "", "dgenerica_cas": "COLEGIO RURAL AGRUPADO", "despecifica": "EL PONT", "localidad_oficial": "ALQUERIA (L')"},
        {**base, "codcen": "12000003", "cod_estado": "B"},
        {**base, "codcen": " ", "cod_estado": "A"},
    ]
    df = spark.createDataFrame([tuple(d[c] for c in centres.COLUMNS) for d in data], ", ".join(f"{c} string" for c in centres.COLUMNS))
    got = centres.centre_rows(df)
    assert got.columns == schemas.names_of(schemas.CENTRES)
    assert rows(got.select("code", "name", "municipality", "province", "phone", "web", "lat", "lon")) == [("03000002", "Colegio Rural Agrupado El Pont", "L'Alqueria", "Alacant/Alicante", "", "", None, None), ("46000001", "IES Jaume I", "Valencia", "València/Valencia", "", "w", 39.5, None)]

    def broken():
        raise OSError("no answer")

    assert centres.or_previous(broken, got).count() == 2


def test_named_rows(spark):
    df = spark.createDataFrame([({"offer_order": "3", "center_code": "46000001", "hours": "x"},)], "r map<string,string>")
    row = schemas.keyed(df, "r", schemas.OFFERS).first()
    assert (row["offer_order"], row["center_code"], row["hours"], row["body"]) == (3, "46000001", None, None)


def test_unclosed_anchors_give_no_link(spark):
    page = '<a href="/a">one<a href="/b#x">two <b>bold</b></a><a href="/c">open'
    df = spark.createDataFrame([(2**60 + 1, "http://h/p", page), (None, "http://h/p", None)], "page_id long, url string, html string")
    assert rows(html.page_links(df, "page_id", "url", "html")) == [(2**60 + 1, 0, "http://h/b", "two bold")]


def test_fetch_uses_the_whole_window():
    now, seen = [0.0], []

    def request(timeout):
        seen.append((now[0], timeout))
        now[0] += 10
        raise OSError("down")

    with pytest.raises(OSError, match="down"):
        fetch.fetch_within(request, window=100, first_timeout=20, later_timeout=60, delay=45, clock=lambda: now[0], pause=lambda s: now.__setitem__(0, now[0] + s))
    assert seen == [(0.0, 20), (55.0, 45.0), (100.0, 1.0)]
    seen.clear()
    with pytest.raises(OSError, match="down"):
        fetch.fetch_within(request, window=0, clock=lambda: now[0], pause=lambda s: None)
    assert len(seen) == 1 and seen[0][1] == 120


def test_report_and_observation(spark, tmp_path):
    from rankloom.sources import tables

    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    rules = {"positive": F.col("v") > 0, "key": F.col("k") > 0}
    path = str(tmp_path / "report.json")
    assert quality.write_report(df, "k", rules, path) is False
    assert tables.read_json(path) == {"violations": {"positive": 2, "key": 0}, "errors": [{"rule": "positive", "key": "2"}, {"rule": "positive", "key": "3"}]}
    assert quality.write_report(df.filter("v > 0"), "k", rules, path)
    out, seen = quality.observed(df, rules)
    assert out.count() == 3 and seen.get == {"positive": 2, "key": 0}


def test_scratch_tables(spark, tmp_path):
    from types import SimpleNamespace

    from rankloom import scratch

    s = scratch.Scratch(spark, "test")
    a, b = s.table(spark.range(3), "a"), s.table(spark.range(4), "b")
    s.keep_only(b)
    assert b.count() == 4
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        a.collect()
    s.drop_all()
    # Without a shared folder a cluster is refused.
    conf = SimpleNamespace(get=lambda *_: None)
    for master, refused in (("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True), ("local[4]", False)):
        fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master=master, applicationId="test-app"))
        if refused:
            with pytest.raises(RuntimeError, match="checkpoint"):
                scratch.shared_dir(fake)
        else:
            assert scratch.shared_dir(fake).startswith("file://")


def test_stale_course_is_emptied_by_a_new_start(spark):
    stale = spark.createDataFrame([("46000001", "126", 3, "S", "C", "M", "maestros", "vacante", False, False, o, "2024-2025", "2024-10-01", "old") for o in ("curso", "inicio")], STATE)
    empty, ledger = spark.createDataFrame([], STATE), spark.createDataFrame([], merge.LEDGER)
    out = cuts.run(empty, stale, ledger, awards(spark, award("n", "2025-07-20", 8)), guide(spark), "inicio")
    assert rows(out["course"].select("school_year", "cut", "origin")) == [("2025-2026", 8, "inicio")]
    none = cuts.run(empty, stale, ledger, awards(spark), guide(spark), "inicio")
    assert none["course"].count() == 2 and none["start"].count() == 0


@pytest.mark.parametrize("mode, table", [("inicio", "start"), ("curso", "course")])
def test_documents_without_a_date_belong_to_today(spark, mode, table):
    empty, ledger = spark.createDataFrame([], STATE), spark.createDataFrame([], merge.LEDGER)
    out = cuts.run(empty, empty, ledger, awards(spark, award("u", None, 8)), guide(spark), mode, F.lit("2026-02-03"))
    assert rows(out[table].select("school_year", "cut")) == [("2025-2026", 8)]
    assert rows(out["ledger"].select("url", "rows")) == [("u", 1)]
    later = cuts.run(empty, empty, ledger, awards(spark, award("u", "no date", 8)), guide(spark), mode)
    assert later[table].count() == 1
    odd = spark.createDataFrame([("a", None), ("b", "2025-2026"), ("c", "2024-2025")], "k string, p string")
    assert rows(merge.reset_period(odd, odd.limit(0), "p").select("k")) == [("a",), ("b",)]
    assert merge.reset_period(odd.filter("p is null"), odd.limit(0), "p").count() == 1


def test_assignments_are_kept_through_the_course(spark):
    from rankloom.pipelines import assignments

    profiles = spark.createDataFrame(
        [(1, 0, "PÉREZ GIL, ANA", "126", "maestros", 5, 2), (2, 0, "RUIZ, EVA", "126", "maestros", None, 3), (3, 0, "SANZ, PAU", "3A1", "secundaria", 8, 4), (4, 0, "SANZ, PAU", "3A1", "secundaria", 9, 6), (5, 0, "DE LA O, IU", "3A1", "secundaria", 11, 7)],
        "person_index int, position_index int, official_name string, specialty_code string, body string, after_order int, initial_order int",
    )
    none = (spark.createDataFrame([], schemas.ASSIGNMENTS), spark.createDataFrame([], assignments.SKIPPED))
    go = lambda state, skipped, data, year, mode: assignments.run(state, skipped, awards(spark, *data), profiles, "2026-2027", year, mode)
    # Before a start of the year the course waits.
    early = go(*none, [award("c0", "2026-10-01", 5, name="Pérez Gil, Ana")], "2025-2026", "curso")
    assert early["state"].count() == 0 and early["state_year"] == "2025-2026"
    start = [
        award("m", "2026-07-20", 5, seq=1, name="Pérez Gil, Ana"), award("m", "2026-07-20", 6, seq=2, name="RUIZ, EVA"), award("m", "2026-07-20", 6, seq=3, name="Ruiz, Eva"), award("m", "2026-07-20", 7, seq=4, name="Nobody, X"),
        award("m", "2026-07-20", 1, seq=5, code="", name="A, B"), award("m", "2026-07-20", 1, seq=6, centre="99000001", name="A, B"), award("old", "2025-07-20", 1, seq=1, name="RUIZ, EVA"), award("un", None, 1, seq=1),
        award("s", "2026-07-21", 8, seq=1, code="3A1", body="secundaria", name="Sanz, Pau"),
    ]
    first = go(*none, start, None, "inicio")
    view = lambda out: rows(out["state"].select("person_index", "after_order", "initial_order", "source_url", "mode"))
    assert view(first) == [(-1, 7, None, "m", "inicio"), (1, 5, 2, "m", "inicio"), (2, 6, 3, "m", "inicio"), (3, 8, 4, "s", "inicio")] and first["state_year"] == "2026-2027"
    assert rows(first["skipped"]) == [("inicio", "maestros", r, 1) for r in ("duplicate_assignment", "initial_position_without_profile", "unknown_province", "without_specialty")]
    course = [
        award("c2", "2026-11-01", 99, seq=1, code="3A1", body="secundaria", name="Sanz, Pau"), award("c1", "2026-10-01", 9, seq=1, code="3A1", body="secundaria", name="SANZ, PAU", centre="46000009"),
        award("c3", "2026-12-01", 3, seq=1, code="3A1", body="secundaria", name="Delao, Iu"), award("c3", "2026-12-01", 3, seq=2, name="Nobody, X", code="3A1", body="secundaria"),
    ]
    second = go(first["state"], first["skipped"], course, "2026-2027", "curso")
    # c1 names the order of the second profile; by then both have one, so c2 is open; c3's name agrees without blanks.
    assert view(second) == [(-1, 7, None, "m", "inicio"), (1, 5, 2, "m", "inicio"), (2, 6, 3, "m", "inicio"), (3, 8, 4, "s", "inicio"), (4, 9, 6, "c1", "curso"), (5, 11, 7, "c3", "curso")]
    assert [r for r in rows(second["skipped"]) if r[0] == "curso"] == [("curso", "secundaria", "without_unique_profile", 1)]
    # One earlier assignment settles a name that is open; an older document doesn't replace it, a corrected start does.
    third = go(first["state"], first["skipped"], [award("c2", "2026-11-01", 99, seq=1, code="3A1", body="secundaria", name="Sanz, Pau")], "2026-2027", "curso")
    assert view(third)[3] == (3, 8, 4, "c2", "curso")
    fourth = go(third["state"], third["skipped"], [award("c9", "2026-09-01", 98, seq=1, code="3A1", body="secundaria", name="Sanz, Pau")], "2026-2027", "curso")
    assert view(fourth)[3] == (3, 8, 4, "c2", "curso")
    fifth = go(fourth["state"], fourth["skipped"], [award("s2", "2026-12-20", 9, seq=1, code="3A1", body="secundaria", name="Sanz, Pau")], "2026-2027", "inicio")
    assert [r for r in view(fifth) if r[0] > 2] == [(4, 9, 6, "s2", "inicio")]


def test_snapshots_by_rows_break_the_same_rules_as_in_one_row(spark):
    names = schemas.names_of(schemas.OFFERS)
    item = lambda order="1", code="03000001", kind="vacante", cells=13: ([order] + [""] * 4 + [code] + [""] * 6 + [kind])[:cells]
    lists = {"a": [item(), item("2")], "b": [item(), item()], "c": [item(code="x")], "d": [item(kind="")], "e": [item(cells=12)], "f": [], "g": [item(None), item(None)], "h": [item(code=None)], "i": [item()], "j": [item()]}
    head = lambda k: (k, quality.OFFER_DATASET, quality.OFFER_MODE, "2025-2026" if k == "i" else "2026-2027", quality.OFFER_STATUS, None if k == "j" else "2026-09-01", names)
    schema = "sha256 string, dataset string, update_mode string, academic_year string, status string, publication_date string, item_fields array<string>"
    heads = spark.createDataFrame([head(k) for k in lists], schema)
    whole = spark.createDataFrame([(*head(k), v) for k, v in lists.items()], schema + ", items array<array<string>>")
    items = spark.createDataFrame([(k, x) for k, v in lists.items() for x in v], "sha256 string, item array<string>")
    got = rows(quality.offer_snapshot_violations(heads, items, F.lit("2026-2027"), names))
    assert got == rows(offers.broken_payloads(whole, "2026-2027")) and len({k for _, k in got}) == 9


def test_only_documents_that_can_decide_are_cut(spark):
    """Random documents of several years and odd dates, against all cuts of all documents; and awards of documents that
    cannot give rows are counted for the ledger, not cut (their names fail where they are read)."""
    import random

    rng, today = random.Random(3), F.lit("2026-02-03")
    dates = ["2024-07-20", "2024-10-01", "2025-06-30", "2025-07-01", "2025-10-02", "2026-01-05", None, "soon", ""]
    empty = spark.createDataFrame([], STATE)
    held = spark.createDataFrame([("46000001", c, 3, "S", "C", "M", b, "vacante", False, False, "curso", "2024-2025", "2024-10-01", "old") for c, b in (("126", "maestros"), ("3A1", "secundaria"))], STATE)
    ledger = spark.createDataFrame([("u0", "sha-u0", "curso", "maestros", None, 1, None)], merge.LEDGER)
    for mode in ("inicio", "curso"):
        for state in (empty, held):
            kinds = [("126", "maestros"), ("3A1", "secundaria"), ("3A1", "maestros")]
            data = [award(u, rng.choice(dates) if u == "u7" else dates[(int(u[1:]) * 5) % 9] if u else dates[3], rng.randrange(9), rng.choice(["46000001", "03000009"]), *rng.choice(kinds), seq=i) for i in range(80) for u in [rng.choice([*(f"u{n}" for n in range(9)), None])]]
            data.append(award("u1-copy", "2026-01-06", 9, seq=99, sha="sha-u0"))
            out = cuts.run(state, state, ledger, awards(spark, *data), guide(spark), mode, today)
            fresh = awards(spark, *data).filter("url is null or url not in ('u0', 'u1-copy')")
            every = cuts.document_cuts(fresh, guide(spark), today)
            start = cuts.apply_start(state, every) if mode == "inicio" else state
            course = cuts.course_after_start(state, state, start) if mode == "inicio" else cuts.apply_course(state, state, every)
            text = lambda df: sorted(str(tuple(r)) for r in df.select(*state.columns).collect())
            assert text(out["start"]) == text(start) and text(out["course"]) == text(course)
            counts = {r["url"]: r["rows"] for r in out["ledger"].collect()}
            assert {u: n for u, n in counts.items() if u != "u0" and n} == {r["url"]: r["count"] for r in every.groupBy("url").count().collect() if r["url"]}
    older = awards(spark, award("old", "2024-10-01", 5), award("new", "2025-10-01", 6))
    failing = older.withColumn("center_name", F.when(F.col("url") == "old", F.raise_error(F.lit("read"))).otherwise(F.col("center_name")))
    out = cuts.run(empty, empty, ledger, failing, guide(spark), "curso", today)
    assert rows(out["course"].select("cut", "school_year")) == [(6, "2025-2026")]
    assert rows(out["ledger"].filter("url <> 'u0'").select("url", "rows")) == [("new", 1), ("old", 1)]


@pytest.mark.parametrize("mode", ["inicio", "curso"])
def test_assignments_broadcast_neither_awards_nor_profiles(spark, tmp_path, mode):
    """Both grow, and Spark's sizes of files say little of their size in memory."""
    from rankloom.pipelines import assignments

    schema = "person_index int, position_index int, official_name string, specialty_code string, body string, after_order int, initial_order int"
    filed = lambda df, n: df.write.parquet(f"{tmp_path}/{n}") or spark.read.schema(df.schema).parquet(f"{tmp_path}/{n}")  # noqa: E731  with a size
    profiles = filed(spark.createDataFrame([(1, 0, "RUIZ, EVA", "126", "maestros", 5, 2)], schema), "profiles")
    data = [award("u", "2026-10-01", 5, seq=1, name="Ruiz, Eva"), award("u", "2026-10-01", 5, seq=2, name="RUIZ, EVA"), award("u", "2026-10-01", 7, seq=3, name="Nobody, X"), award("u", "2026-10-01", 7, seq=4, name="nobody x"), award("u", "2026-10-01", 7, seq=5, code="")]
    resolved, skipped = assignments.resolve_document(filed(awards(spark, *data), "awards"), profiles, filed(spark.createDataFrame([], schemas.ASSIGNMENTS), "state"), mode)
    assert all("Broadcast" not in df._jdf.queryExecution().executedPlan().toString() for df in (resolved, skipped))
    start = mode == "inicio"
    assert rows(resolved.select("person_index", "after_order")) == ([(-1, 7)] if start else []) + [(1, 5)]
    # Of two awards by one name the second is without a profile and a duplicate, in that it would be kept by name.
    assert rows(skipped) == sorted([("duplicate_assignment", 2 if start else 1), ("initial_position_without_profile" if start else "without_unique_profile", 2), ("without_specialty", 1)])

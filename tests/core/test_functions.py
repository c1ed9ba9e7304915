import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankloom.functions import blocks, calendar, classify, text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("function", "given", "want"),
    [
        (text.folded, " ÀÉ  ñ Ü\t", "ae n u"),
        (text.folded, None, ""),
        (text.squeeze, " a \n b ", "a b"),
        (text.identity_key, "Mª José, D'Àvila-Ruiz", "MARIA JOSE D AVILA RUIZ"),
        (text.compact_key, "De la Fuente", "DELAFUENTE"),
        (text.token_key, "b, a c", "A B C"),
        (text.official_name, "PEREZ  DE TAL ,  ANA", "PEREZ DE TAL, ANA"),
        (text.zero_is_blank, " 0 ", ""),
        (text.header_key, "Motivos Exclusión", "motivosexclusion"),
        (text.smart_title, "CEIP LA FONT D'EN CARRÒS", "CEIP La Font d'en Carròs"),
        (text.smart_title, "IES JAUME I", "IES Jaume I"),
        (text.smart_title, "COL·LEGI SANT JOAN XII", "Col·legi Sant Joan XII"),
        (text.smart_title, "CP PUB.MESTRE D'ESCOLA DE L'HORTA I DELS POBLES", "Cp Púb.Mestre d'escola de L'Horta i dels Pobles"),
        (text.smart_title, "ceip pub. la llum", "CEIP Pub. La Llum"),
        (text.smart_title, "joan carles i  y carlos iii el 1er 2n", "Joan Carles I y Carlos III El 1er 2N"),
        (text.smart_title, "FPA EL PALLETER-XI ceipx", "FPA El Palleter-XI Ceipx"),
        (text.smart_title, "D'", "D'"),
        (text.smart_title, "l'i l'alqueria", "L'I L'Alqueria"),
        (text.smart_title, "PROTOCOL·LEGI", "Protocol·Legi"),
        (text.smart_title, "jaume-i", "Jaume-i"),
        (text.smart_title, None, ""),
        (text.display_place, "ALCUDIA (L')", "L'Alcudia"),
        (text.display_place, "ELIANA (l’)", "L'Eliana"),
        (text.display_place, "POBLA DE VALLBONA (La)", "La Pobla de Vallbona"),
        (text.display_place, "X (LO)", "X (Lo)"),
        (text.display_place, "VILA JOIOSA (LA)", "La Vila Joiosa"),
        (text.display_name, "GARCÍA PÉREZ, ANA MARÍA", "Ana María García Pérez"),
        (classify.placement, "Substitució indeterminada", "sub_indeterminada"),
        (classify.placement, "sustitución determinada", "sub_determinada"),
        (classify.placement, "Jornada VACANT Adjudicat", "vacante"),
        (classify.placement, "vacantes", ""),
        (classify.status, "No ha participat hui", "N"),
        (classify.status, "Ha participado", "P"),
        (classify.status, "Adjudicada", "A"),
        (classify.status, "desactivat x", "D"),
        (classify.status, "adjudicatx", None),
        (classify.body, "x Mestres / Maestros", "maestros"),
        (classify.owner, "128", "maestros"),
        (classify.owner, "3A1", "secundaria"),
        (classify.province_name, "CASTELLÓ", "Castellón"),
        (classify.workload, "23 horas Itinerante", "23"),
        (classify.workload, "Jornada completa", "C"),
        (classify.offered_hours, "ING-B2 11,5", 11.5),
        (classify.offered_hours, "ING B2", None),
        (classify.centre_kind, "Instituto de Educación Secundaria", "IES"),
        (calendar.valid_year, "2026 / 2027", "2026-2027"),
        (calendar.valid_year, "2026-2028", None),
        (calendar.start_year, "2026-2027", 2026),
        (calendar.date_in, "x 2026-02-03.pdf", dt.date(2026, 2, 3)),
        (calendar.date_in, "x 31_02_2026", None),
        (calendar.printed_date, "on 05/03/2026", dt.date(2026, 3, 5)),
    ],
)
def test_scalars(spark, function, given, want):
    assert one(spark, function, given) == want


def test_english(spark):
    f = lambda t, b: spark.range(1).select(classify.english_required(F.lit(t), F.lit(b)).alias("r")).first()["r"]
    assert f("x / ING.23 horas", "maestros") and not f("x / ING.23 horas", "secundaria") and not f("x / inglés", "maestros")


def test_unknown_values_raise(spark):
    with pytest.raises(Exception, match="unknown placement"):
        one(spark, classify.offered_placement, "otra")
    with pytest.raises(Exception, match="unknown modes"):
        one(spark, calendar.chosen_modes, "inicio,x")
    assert one(spark, calendar.chosen_modes, "puestos, inicio") == ["inicio", "puestos"]


@pytest.mark.parametrize(
    ("when", "modes"),
    [
        ("2026-07-20 07:00:00", ["inicio", "posiciones"]),
        ("2026-07-01 07:00:00", ["inicio", "posiciones", "puestos"]),
        ("2026-10-06 10:00:00", ["curso"]),
        ("2026-01-06 11:00:00", ["curso"]),
        ("2026-07-19 07:00:00", ["posiciones"]),
        ("2026-11-06 11:00:00", ["acreditaciones"]),
        ("2026-08-07 12:00:00", []),
        ("2026-10-05 07:30:00", ["puestos"]),
    ],
)
def test_due_modes(spark, when, modes):
    assert spark.range(1).select(calendar.due_modes(F.lit(when).cast("timestamp")).alias("m")).first()["m"] == modes


def test_years(spark):
    row = spark.sql("select date'2026-07-01' as d").select(
        calendar.school_year(F.col("d")), calendar.school_year(F.col("d"), calendar.AUGUST), calendar.school_year(F.col("d"), calendar.AFTER_FIRST_OF_JULY), calendar.allowed_years(F.col("d")),
        calendar.mentions_allowed_year(F.lit("curso 2025 / 2026"), F.array(F.lit("2026-2027"))), calendar.mentions_allowed_year(F.lit("none"), F.array(F.lit("2026-2027"))),
    ).first()
    assert list(row) == ["2026-2027", "2025-2026", "2025-2026", ["2025-2026", "2026-2027"], False, True]


def award(spark, lines, body, page=None):
    df = spark.createDataFrame([(lines, body, page)], "lines array<string>, body string, page_specialty struct<code:string,name:string>")
    return blocks.awards(df).first()["award"]


BLOCK = ["95 APELLIDO EJEMPLO, NOMBRE Peticion: 1 Voluntaria", "921979 MUNICIPIO(12000251)CENTRO DE PRUEBA", "219 / TECNOLOGIA", "Jornada completa VACANT Adjudicat"]


def test_awards(spark):
    a = award(spark, BLOCK, "secundaria", ("219", "TECNOLOGIA"))
    assert (a.cut, a.candidate_name, a.center_code, a.locality, a.center_name, a.placement_type, a.workload) == (95, "APELLIDO EJEMPLO, NOMBRE", "12000251", "MUNICIPIO", "CENTRO DE PRUEBA", "vacante", "C")
    assert award(spark, BLOCK, "secundaria", ("220", "OTRA")) is None
    assert award(spark, BLOCK, "secundaria") is None
    assert award(spark, BLOCK, "maestros").specialty_code == "219"
    assert award(spark, BLOCK[:3], "maestros") is None
    assert award(spark, [], "maestros") is None


@pytest.mark.parametrize(("line", "want"), [("219 TECNOLOGIA", ("219", "TECNOLOGIA")), ("TECNOLOGIA219", ("219", "TECNOLOGIA")), ("2A5 NAME, WITH COMMA", ("2A5", "NAME, WITH COMMA")), ("A / 219", None)])
def test_page_specialty(spark, line, want):
    got = one(spark, blocks.page_specialty, f"head\n Altres Cossos /  Otros Cuerpos\n\n{line}")
    assert (tuple(got) if got else None) == want
    assert one(spark, blocks.page_specialty, "no marker\n219 X") is None

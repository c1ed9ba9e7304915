"""The guide of centres: a CSV of text columns to the sixteen columns of the published table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.text import display_place, lookup, smart_title, squeeze, zero_is_blank
from ..schemas import CENTRES

# Columns of the guide, states that count, provinces by the first digits of a code, words that show a
# centre's kind in its name.
COLUMNS = ("codcen", "dlibre", "dgenerica_cas", "dgenerica_val", "despecifica", "regimen", "direccion", "codpos", "telef", "mail", "web", "localidad_oficial", "noms_mun", "comarca", "provincia", "cod_estado", "latitud", "longitud")
OPEN_STATES, OFFICIAL_PLACE = ("A", "L"), "L"
PROVINCES = {"03": "Alacant/Alicante", "12": "Castelló/Castellón", "46": "València/Valencia"}
SHOWN_KIND = r"(?iu)^(CEIP|CEP|CEE|CRA|IES|CIPFP|CFPA|FPA|EOI|EI|CENTR[EO]|COL[E·]GI|COLEGIO|ESCOLA|ESCUELA|CONSERVATORI|CONSERVATORIO|SECCI[ÓO]N|SECCI[ÓO]|AULARIO)\b"


def _first_filled(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(squeeze(c), F.lit("")) for c in columns], F.lit(""))


def centre_name(free: Column, generic: Column, specific: Column) -> Column:
    """The centre's own name with its kind before it unless the name shows one; without one, what kind it is."""
    own, kind = squeeze(free), classify.centre_kind(generic)
    named = F.when((kind != "") & ~own.rlike(SHOWN_KIND), F.concat_ws(" ", kind, own)).otherwise(own)
    parts = F.array_join(F.filter(F.array(F.coalesce(generic, F.lit("")), F.coalesce(specific, F.lit(""))), lambda x: x != ""), " ")
    return smart_title(F.when(own != "", named).otherwise(parts))


def centre_rows(guide: DataFrame) -> DataFrame:
    """Open centres in the columns of schemas.CENTRES; rows without a code are left out."""
    c = F.col
    code = squeeze(c("codcen"))
    state = F.upper(squeeze(c("cod_estado")))
    by_state = F.when(state == OFFICIAL_PLACE, c("localidad_oficial")).otherwise(c("noms_mun"))
    place = _first_filled(by_state, c("noms_mun"), c("localidad_oficial"))
    columns = {
        "code": code,
        "name": centre_name(c("dlibre"), c("dgenerica_cas"), c("despecifica")),
        "type_es": smart_title(c("dgenerica_cas")),
        "type_va": smart_title(c("dgenerica_val")),
        "regime": smart_title(c("regimen")),
        "address": squeeze(c("direccion")),
        "postcode": squeeze(c("codpos")),
        "phone": zero_is_blank(c("telef")),
        "email": squeeze(c("mail")),
        "web": zero_is_blank(c("web")),
        "web_va": F.lit(""),
        "municipality": display_place(place),
        "district": squeeze(c("comarca")),
        "province": F.coalesce(F.nullif(squeeze(c("provincia")), F.lit("")), lookup(PROVINCES, F.substring(code, 1, 2)), F.lit("")),
        "lat": c("latitud").try_cast("double"),
        "lon": c("longitud").try_cast("double"),
    }
    assert ", ".join(columns) == ", ".join(x.split(" ")[0] for x in CENTRES.split(", "))
    return guide.filter((code != "") & state.isin(*OPEN_STATES)).select(*[v.alias(k) for k, v in columns.items()])


def or_previous(load: Callable[[], DataFrame], previous: DataFrame) -> DataFrame:
    """What load gives; the previous table where the source can't be had."""
    try:
        return load()
    except Exception:  # any failure of the source: the guide of the last run is still good
        return previous

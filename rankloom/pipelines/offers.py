"""Offered positions: the latest valid snapshot of a school year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge, quality
from ..schemas import OFFERS, names_of, positional


def valid_payloads(payloads: DataFrame, target_year: str) -> DataFrame:
    """Payloads that break no rule; the others are in broken_payloads, with the rules they break."""
    test = F.lit(True)
    for ok in quality.offer_payload_rules(F.lit(target_year), names_of(OFFERS)).values():
        test = test & F.coalesce(ok, F.lit(False))
    return payloads.filter(test)


def broken_payloads(payloads: DataFrame, target_year: str) -> DataFrame:
    return quality.violations(payloads, "sha256", quality.offer_payload_rules(F.lit(target_year), names_of(OFFERS)))


def item_rows(payloads: DataFrame) -> DataFrame:
    """academic_year, publication_date, sha256 and the typed columns of items, a row for each item."""
    rows = payloads.select("academic_year", "publication_date", "sha256", F.explode("items").alias("r"))
    names = names_of(OFFERS)
    keep = rows.select("academic_year", "publication_date", "sha256", "r")
    typed = positional(keep.withColumn("__k", F.struct("academic_year", "publication_date", "sha256")), "r", names, OFFERS, keep=["__k"])
    return typed.select("__k.*", *names)


def update(state: DataFrame, payloads: DataFrame, target_year: str) -> DataFrame:
    """The published rows after a visit of the page: the newest valid payload of the target year replaces what there is;
    a new year without one empties it."""
    items = item_rows(valid_payloads(payloads, target_year))
    return merge.snapshot_for_year(state, items.select(*state.columns), "academic_year", "publication_date", "sha256", target_year)


def update_from_items(state: DataFrame, heads: DataFrame, items: DataFrame, target_year: str) -> DataFrame:
    """As update, for snapshots whose items are rows (sha256, item); see quality.offer_snapshot_violations."""
    broken = quality.offer_snapshot_violations(heads, items, F.lit(target_year), names_of(OFFERS)).select(F.col("key").alias("sha256")).distinct()
    valid = heads.join(broken, "sha256", "left_anti").select("sha256", "academic_year", "publication_date")
    rows = items.join(valid, "sha256").select(F.struct("academic_year", "publication_date", "sha256").alias("__k"), "item")
    typed = positional(rows, "item", names_of(OFFERS), OFFERS, keep=["__k"]).select("__k.*", *names_of(OFFERS))
    return merge.snapshot_for_year(state, typed.select(*state.columns), "academic_year", "publication_date", "sha256", target_year)

"""The queries of the core operators, side by side with their SQL."""

from __future__ import annotations

from .plans import catalogue, updates  # noqa: F401  updates adds its entries to the catalogue's


def queries() -> dict:
    return {name: q for name, (q, _) in catalogue.ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in catalogue.ENTRIES.items() if sql}

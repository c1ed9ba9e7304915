"""Small helpers on column names, so that extra columns of an input never clash with working ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, by exact name, each once; the first of columns that differ in case only."""
    return pick_as(df, {n: n for n in names})


def pick_as(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New name -> column, found as pick finds it; a column may be taken more than once."""
    names = list(columns.values())
    have = {}
    for i, c in enumerate(df.columns):
        have.setdefault(c, i)
        have.setdefault(c.lower(), i)
    at = [have[n] if n in have else have[n.lower()] for n in names]
    if len(set(x.lower() for x in df.columns)) == len(df.columns):
        return df.select(*[F.col(f"`{df.columns[i]}`").alias(n) for i, n in zip(at, columns)])
    renamed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, columns)])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

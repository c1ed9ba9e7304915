"""Scalar rules of positions on lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes whose lists count English credentials, and the code that is one.
ENGLISH_CODES = ("120", "123", "124", "126", "127", "128", "153")
ENGLISH_SPECIALTY = "121"


def compatible_rank(after_awards: Column, initial: Column) -> Column:
    """The rank among the active after the awards where there is one, else the initial one."""
    return F.coalesce(after_awards, initial)


def effective_disabled(matched: Column, awarded_flag: Column, listed_flag: Column) -> Column:
    """What the award list says of a matched person, else the mark of the list itself; null is false."""
    return F.coalesce(F.when(F.coalesce(matched, F.lit(False)), awarded_flag).otherwise(listed_flag), F.lit(False))


def english_contribution(has_specialty: Column, accredited: Column) -> Column:
    return F.coalesce(has_specialty, F.lit(False)).cast("int") + F.coalesce(accredited, F.lit(False)).cast("int")


def last_digits(text: Column, n: int = 6) -> Column:
    """The last n digits in order of writing; null where there are fewer."""
    digits = F.regexp_replace(text, "[^0-9]+", "")
    return F.when(F.length(digits) >= n, F.substring(digits, -n, n))


def positive_integer(c: Column) -> Column:
    """Text of a whole number from 1 on, as one; null for all else."""
    value = F.trim(c.cast("string")).try_cast("int")
    return F.when(value >= 1, value)


def finite(c: Column) -> Column:
    """A number that is neither null, infinite nor NaN."""
    value = c.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), F.lit(False))

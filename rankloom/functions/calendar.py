"""School years with an explicit boundary, calendar windows and dates found in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Boundaries in use: first of July, first of August, second of July.
JULY, AUGUST, AFTER_FIRST_OF_JULY = (7, 1), (8, 1), (7, 2)


def school_year(date: Column, starts: tuple[int, int] = JULY) -> Column:
    """'y-(y+1)', where a year starts on the given month and day; null for null."""
    month, day = starts
    new = (F.month(date) > month) | ((F.month(date) == month) & (F.dayofmonth(date) >= day))
    first = F.year(date) - F.when(new, 0).otherwise(1)
    return F.when(date.isNotNull(), F.concat_ws("-", first, first + 1))


def valid_year(c: Column) -> Column:
    """'y-(y+1)' or 'y/(y+1)', blanks allowed, as 'y-(y+1)'; null for anything else."""
    a, b = (F.regexp_extract(c, r"^\s*(\d{4})\s*[-/]\s*(\d{4})\s*$", i) for i in (1, 2))
    return F.when(F.try_add(a.try_cast("int"), F.lit(1)) == b.try_cast("int"), F.concat_ws("-", a, b))


def start_year(c: Column) -> Column:
    return F.regexp_extract(valid_year(c), r"^(\d{4})", 1).try_cast("int")


def allowed_years(date: Column) -> Column:
    """The year that August starts, and in June and July also the coming one."""
    coming = F.concat_ws("-", F.year(date), F.year(date) + 1)
    return F.array_distinct(F.when(F.month(date).isin(6, 7), F.array(school_year(date, AUGUST), coming)).otherwise(F.array(school_year(date, AUGUST))))


def years_mentioned(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"(20\d{2}\s*[-/]\s*20\d{2})"), F.lit(1)), lambda y: F.regexp_replace(y, r"\s*[-/]\s*", "-")))


def mentions_allowed_year(text: Column, allowed: Column) -> Column:
    """False only if years are mentioned and none of them is allowed."""
    years = years_mentioned(text)
    return (F.size(years) == 0) | F.arrays_overlap(years, allowed)


def date_in(text: Column) -> Column:
    """yyyy-mm-dd in any of -_/ first, else dd-mm-yyyy; a date that the calendar has, or null."""
    ymd = r"(?<!\d)(20\d{2})[-_/](\d{2})[-_/](\d{2})(?!\d)"
    dmy = r"(?<!\d)(\d{2})[-_/](\d{2})[-_/](20\d{2})(?!\d)"
    part = lambda p, i: F.regexp_extract(text, p, i)
    found = F.when(text.rlike(ymd), F.concat_ws("-", *(part(ymd, i) for i in (1, 2, 3)))).when(text.rlike(dmy), F.concat_ws("-", *(part(dmy, i) for i in (3, 2, 1))))
    return found.try_cast("date")


def printed_date(text: Column) -> Column:
    """The first dd/mm/yyyy."""
    p = r"\b(\d{2})/(\d{2})/(\d{4})\b"
    return F.when(text.rlike(p), F.concat_ws("-", *(F.regexp_extract(text, p, i) for i in (3, 2, 1)))).try_cast("date")


# The hours of each check.
_FIVE, _SIX, _NOON = (9, 12, 15, 18, 21), (9, 11, 13, 15, 17, 19), (12, 14, 16, 18, 20)


def due_modes(utc: Column, zone: str = "Europe/Madrid") -> Column:
    """array<string> of the checks due in the hour of a UTC timestamp, local time deciding."""
    t = F.from_utc_timestamp(utc, zone)
    month, hour, day = F.month(t), F.hour(t), F.weekday(t) + 1  # Monday 1
    summer = month.isin(7, 8)
    rules = {
        "inicio": summer & (day != 7) & hour.isin(*_FIVE),
        "curso": ~summer & day.isin(2, 4) & hour.isin(*_FIVE),
        "posiciones": month.isin(6, 7) & hour.isin(*_SIX),
        "acreditaciones": (month != 8) & (day == 5) & hour.isin(*_NOON),
        "puestos": (~summer | ((month == 7) & (F.dayofmonth(t) == 1))) & day.isin(1, 3) & hour.isin(*_SIX),
    }
    return F.array_compact(F.array(*[F.when(rule, mode) for mode, rule in rules.items()]))


# Names of the checks, in canonical order.
MODES = ("inicio", "curso", "posiciones", "acreditaciones", "puestos")


def chosen_modes(requested: Column) -> Column:
    """A comma list in canonical order; unknown names raise."""
    names = F.filter(F.transform(F.split(requested, ","), lambda x: F.trim(x)), lambda x: x != "")
    known = F.array(*map(F.lit, MODES))
    wrong = F.array_except(names, known)
    return F.when(F.size(wrong) > 0, F.raise_error(F.concat(F.lit("unknown modes: "), F.array_join(wrong, ", "))).cast("array<string>")).otherwise(F.array_intersect(known, names))

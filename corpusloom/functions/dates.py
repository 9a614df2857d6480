"""Partial dates stay strings; only the year is parsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, strip, text_or_empty

YEAR_PATTERN = r"\b(\d{4})\b"


def year_in(c: Column | str) -> Column:
    """First stand-alone four-digit number as int, else null."""
    return F.nullif(F.regexp_extract(F.coalesce(_c(c), F.lit("")), YEAR_PATTERN, 1), F.lit("")).cast("int")


def publication_year(year: Column | str, date: Column | str) -> Column:
    """Year of the year cell, else of the date cell."""
    return F.coalesce(year_in(year), year_in(date))


def publication_year_blank_only(year: Column | str, date: Column | str) -> Column:
    """As publication_year, but the date is looked at only where the year cell is blank."""
    return F.when(text_or_empty(year) != "", year_in(year)).otherwise(year_in(date))


MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def month_number(c: Column | str) -> Column:
    """Two digits for a month name (its first three letters decide); anything else stays as it is."""
    s = strip(c)
    named = F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(f"{i:02d}"))])
    return F.coalesce(F.try_element_at(named, F.lower(F.substring(s, 1, 3))), s)


def partial_date(year: Column, month: Column, day: Column, season: Column, free_text: Column) -> Column:
    """Year[-Month[-Day]]; "Year Month[ Day]" where the month is no number; "Year Season"; the free text without a year."""
    y, d, s = text_or_empty(year), text_or_empty(day), text_or_empty(season)
    m = month_number(text_or_empty(month))
    numeric, tail = m.rlike("^[0-9]+$"), F.when(d != "", F.concat(F.lit(" "), d)).otherwise("")
    return (
        F.when(y == "", text_or_empty(free_text))
        .when((m != "") & numeric & d.rlike("^[0-9]+$"), F.concat_ws("-", y, m, F.lpad(d.try_cast("int").cast("string"), 2, "0")))
        .when((m != "") & numeric, F.concat_ws("-", y, m))
        .when(m != "", F.concat(y, F.lit(" "), m, tail))
        .when(s != "", F.concat_ws(" ", y, s))
        .otherwise(y)
    )


def year_bucket(year: Column) -> Column:
    return (
        F.when(year.isNull(), "missing")
        .when(year < 2000, "before 2000")
        .when(year < 2010, "2000-2009")
        .when(year < 2015, "2010-2014")
        .when(year < 2020, "2015-2019")
        .when(year < 2025, "2020-2024")
        .when(year == 2025, "2025")
        .when(year == 2026, "2026")
        .otherwise("2027+")
    )

"""Date expressions over ISO date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column


def iso_date(value: Column | str) -> Column:
    """Date, NULL where the text is not a date."""
    return as_column(value).try_cast("date")


def earliest(value: Column | str) -> Column:
    """Aggregate: first date as text. Dates aggregate by hashing; a minimum of
    texts would sort all rows first."""
    return F.min(iso_date(value)).cast("string")


def latest(value: Column | str) -> Column:
    """Aggregate: last date as text."""
    return F.max(iso_date(value)).cast("string")


def odd_date(value: Column | str) -> Column:
    """The text where it is not written as an ISO date, else NULL."""
    c = as_column(value)
    return F.when(~F.coalesce(iso_date(c).cast("string") == c, F.lit(False)), c)


def week_start(day: Column | str) -> Column:
    """Monday of the ISO week, as text."""
    return F.date_trunc("week", as_column(day)).cast("date").cast("string")


def sunday_based_weekday(day: Column | str) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(as_column(day)) - 1).cast("bigint")


def date_from_file_name(name: Column | str) -> Column:
    """Text behind the first underscore of the file stem, NULL without one."""
    c = as_column(name)
    ending = F.length(F.substring_index(c, ".", -1)) + 1
    stem = F.when(c.contains("."), F.substr(c, F.lit(1), F.length(c) - ending)).otherwise(c)
    return F.when(stem.contains("_"), F.substr(stem, F.instr(stem, "_") + 1))


def percent_change(now: Column | str, before: Column | str) -> Column:
    """Change in percent with two decimals, NULL without a base."""
    base = F.nullif(as_column(before).cast("double"), F.lit(0.0))
    return F.round((as_column(now) - as_column(before)).cast("double") * 100.0 / base, 2)


def percent_share(part: Column | str, whole: Column | str, digits: int) -> Column:
    base = F.nullif(as_column(whole).cast("double"), F.lit(0.0))
    return F.round(as_column(part).cast("double") * 100.0 / base, digits)

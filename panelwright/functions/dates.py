"""Integer-coded dates (YYYYMMDD, YYYYMM) and their parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwright.functions.values import as_column, integral_div


def iso_date(c: Column | str) -> Column:
    """Text yyyy-MM-dd to date; anything else is null."""
    return F.try_to_date(as_column(c), "yyyy-MM-dd")


def date_of_yyyymmdd(c: Column | str) -> Column:
    return F.try_to_date(as_column(c).cast("string"), "yyyyMMdd")


def yyyymmdd_of_date(c: Column | str) -> Column:
    d = as_column(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def yyyymm_of_date(c: Column | str) -> Column:
    d = as_column(c)
    return F.year(d) * 100 + F.month(d)


def yyyymm_of_yyyymmdd(c: Column | str) -> Column:
    return integral_div(c, 100)


def year_of_yyyymmdd(c: Column | str) -> Column:
    return integral_div(c, 10000)


def year_of_yyyymm(c: Column | str) -> Column:
    return integral_div(c, 100)


def month_of_yyyymm(c: Column | str) -> Column:
    return as_column(c) % 100


def month_index(c: Column | str) -> Column:
    """Consecutive month number of a YYYYMM key, so neighbours differ by one."""
    return integral_div(c, 100) * 12 + as_column(c) % 100


def month_of_text(c: Column | str) -> Column:
    """The month in `M/D` text, also from a bare `M`."""
    return F.get(F.split(as_column(c), "/", 2), 0).try_cast("int")

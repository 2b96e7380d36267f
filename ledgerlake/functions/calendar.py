"""Fiscal-calendar and era-date expressions (Column -> Column).

The fiscal year runs 1 October - 30 September: October-December belong to the
next fiscal year. Years are also written in the Buddhist era (CE + 543).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col

# Era offset and the month that opens the fiscal year.
ERA_OFFSET = 543
FISCAL_START_MONTH = 10


def parse_era_date(text, offset: int = ERA_OFFSET) -> Column:
    """``'DD/MM/YYYY'`` with an era year -> CE DATE; NULL when unparseable.

    The era offset is removed *before* the calendar check, so ``29/02/2567``
    (2024-02-29) is valid even though 2567 itself is not a leap year.
    """
    t = F.trim(col(text))
    shaped = t.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{1,4}$")
    parts = F.split(t, "/")
    year_ce = parts.getItem(2).try_cast("int") - F.lit(offset)
    iso = F.concat_ws("-", year_ce.cast("string"), parts.getItem(1), parts.getItem(0))
    return F.when(shaped & (year_ce > 0), F.try_to_date(iso, "y-M-d"))


def format_era_date(d, offset: int = ERA_OFFSET) -> Column:
    """CE DATE -> ``'DD/MM/YYYY'`` with the era year."""
    d = col(d)
    return F.concat(F.date_format(d, "dd/MM/"), (F.year(d) + F.lit(offset)).cast("string"))


def fiscal_year_ce(d) -> Column:
    d = col(d)
    return (F.year(d) + (F.month(d) >= FISCAL_START_MONTH).cast("int")).cast("int")


def fiscal_year_be(d, offset: int = ERA_OFFSET) -> Column:
    return (fiscal_year_ce(d) + F.lit(offset)).cast("int")


def fiscal_quarter(month) -> Column:
    """Q1 = Oct-Dec ... Q4 = Jul-Sep; floored modulo (``%`` would give -9 for January)."""
    m = col(month)
    return (F.pmod(m - F.lit(FISCAL_START_MONTH), F.lit(12)) / 3).cast("int") + 1


def is_month_end(d) -> Column:
    d = col(d)
    return d == F.last_day(d)


def date_natural_key(d) -> Column:
    """ISO text of a report date: ``'2026-07-03'``."""
    return F.date_format(col(d), "yyyy-MM-dd")


def fiscal_year_natural_key(year_be) -> Column:
    """Natural key of a yearly report: ``'FY2567'``."""
    return F.concat(F.lit("FY"), col(year_be).cast("string"))


def report_file_name(d, ext: str = ".xlsx") -> Column:
    """``2026_07_03.xlsx`` for a report date."""
    return F.concat(F.date_format(col(d), "yyyy_MM_dd"), F.lit(ext))

"""The conformed date dimension fed by a dated source and a yearly source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal

DIM_DATE_COLUMNS = ("date_natural_key", "report_date", "fiscal_year_be", "fiscal_year_ce",
                    "month", "quarter", "is_month_end")


def daily_rows(dates: DataFrame, date_col: str = "report_date") -> DataFrame:
    """One dim_date row per distinct report date."""
    d = dates.select(F.col(date_col).cast("date").alias("report_date")).distinct()
    return d.select(
        cal.date_natural_key("report_date").alias("date_natural_key"),
        "report_date",
        cal.fiscal_year_be("report_date").alias("fiscal_year_be"),
        cal.fiscal_year_ce("report_date").alias("fiscal_year_ce"),
        F.month("report_date").cast("int").alias("month"),
        cal.fiscal_quarter(F.month("report_date")).alias("quarter"),
        cal.is_month_end("report_date").alias("is_month_end"),
    )


def yearly_rows(years_be: DataFrame, year_col: str = "fiscal_year_be") -> DataFrame:
    """One dim_date row per fiscal year; no date, month, quarter or month-end."""
    y = years_be.select(F.col(year_col).cast("int").alias("fiscal_year_be")).distinct()
    return y.select(
        cal.fiscal_year_natural_key("fiscal_year_be").alias("date_natural_key"),
        F.lit(None).cast("date").alias("report_date"),
        "fiscal_year_be",
        (F.col("fiscal_year_be") - F.lit(cal.ERA_OFFSET)).cast("int").alias("fiscal_year_ce"),
        F.lit(None).cast("int").alias("month"),
        F.lit(None).cast("int").alias("quarter"),
        F.lit(None).cast("boolean").alias("is_month_end"),
    )


def build_dim_date(dates: DataFrame | None, years_be: DataFrame | None) -> DataFrame:
    """Union of daily and yearly rows (both sources share one dimension)."""
    parts = []
    if dates is not None:
        parts.append(daily_rows(dates))
    if years_be is not None:
        parts.append(yearly_rows(years_be))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

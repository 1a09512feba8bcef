"""C8 fiscal_calendar: one row per day from the fiscal-year start of the earliest
registration to the end of the fiscal year after ``as_of``."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D

CALENDAR_COLUMNS = ["date_id", "year", "month", "day", "financial_year",
                    "financial_quater", "day_of_week_jp"]


def calendar_bounds(cases: DataFrame, as_of: _dt.date) -> tuple[Column, Column]:
    """(start, end) as scalar columns; the start is a scalar subquery over cases."""
    start = cases.select(D.fiscal_year_start(F.min("registered_date"))).scalar()
    end = D.calendar_end(D.lit_date(as_of))
    return start, end


def fiscal_calendar(cases: DataFrame, as_of: _dt.date) -> DataFrame:
    """C8 with the F4-F7 attributes (``financial_quater`` keeps the upstream spelling)."""
    start, end = calendar_bounds(cases, as_of)
    spark = cases.sparkSession
    days = spark.range(1).select(F.explode(F.when(
        start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY")))).alias("date_id"))
    d = F.col("date_id")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        D.fiscal_year(d).alias("financial_year"),
        D.fiscal_quarter(d).alias("financial_quater"),
        D.weekday_jp(d).alias("day_of_week_jp"),
    )

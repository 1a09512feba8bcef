"""Date helpers: tolerant date parsing, day differences, fiscal calendar arithmetic.

Every function returns a Column and stays inside Spark's expression engine
(no Python UDFs), so whole-stage codegen covers them.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fiscal year starts on 1 April; weekday letters Sunday..Saturday.
FISCAL_START_MONTH = 4
WEEKDAY_JP = ["日", "月", "火", "水", "木", "金", "土"]
# Text date forms accepted by try_date, tried in order.
DATE_FORMS = ["yyyy/M/d", "yyyy-M-d"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_date(d: _dt.date | str) -> Column:
    """A date literal from a ``date`` or an ISO string."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def try_date(c) -> Column:
    """Text -> date, NULL when the text is no date (placeholders, 2024/2/30)."""
    c = _c(c).cast("string")
    return F.coalesce(*[F.try_to_date(c, f) for f in DATE_FORMS])


def days_between(later, earlier) -> Column:
    """``later - earlier`` in whole days as int (NULL if either is NULL)."""
    return F.datediff(_c(later), _c(earlier))


def fiscal_year(d) -> Column:
    """year of (date - 3 months)."""
    return F.year(F.add_months(_c(d), -(FISCAL_START_MONTH - 1)))


def fiscal_quarter(d) -> Column:
    """floor(1 + (month(date - 3 months) - 1) / 3)."""
    m = F.month(F.add_months(_c(d), -(FISCAL_START_MONTH - 1)))
    return F.floor(F.lit(1) + (m - F.lit(1)) / F.lit(3)).cast("int")


def fiscal_year_start(d) -> Column:
    """F8: 1 April of the fiscal year the date falls in."""
    d = _c(d)
    y = F.year(d)
    return F.when(F.month(d) < FISCAL_START_MONTH, F.make_date(y - 1, F.lit(FISCAL_START_MONTH), F.lit(1))) \
        .otherwise(F.make_date(y, F.lit(FISCAL_START_MONTH), F.lit(1)))


def calendar_end(as_of) -> Column:
    """31 March that ends the fiscal year after the one holding ``as_of``."""
    d = _c(as_of)
    y = F.year(d)
    return F.when(F.month(d) < FISCAL_START_MONTH, F.make_date(y + 1, F.lit(3), F.lit(31))) \
        .otherwise(F.make_date(y + 2, F.lit(3), F.lit(31)))


def first_date_of_fiscal_scope(as_of, years: int) -> Column:
    """first day of the fiscal year ``years`` back, counting the current one."""
    d = _c(as_of)
    y = F.year(d)
    return F.when(F.month(d) < FISCAL_START_MONTH,
                  F.make_date(y - F.lit(years), F.lit(FISCAL_START_MONTH), F.lit(1))) \
        .otherwise(F.make_date(y - F.lit(years) + 1, F.lit(FISCAL_START_MONTH), F.lit(1)))


def fiscal_scope_start(as_of: _dt.date, years: int) -> _dt.date:
    """Python twin of :func:`first_date_of_fiscal_scope` for literal ``as_of``."""
    y = as_of.year - years if as_of.month < FISCAL_START_MONTH else as_of.year - years + 1
    return _dt.date(y, FISCAL_START_MONTH, 1)


def weekday_jp(d) -> Column:
    """Japanese weekday letter (Sunday first)."""
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_JP]), F.dayofweek(_c(d)))


def month_start(d) -> Column:
    """first day of the month, as a date."""
    return F.trunc(_c(d), "MM")


def month_end(d) -> Column:
    """last day of the month."""
    return F.last_day(_c(d))


def _digits(number: Column, d: Column, form: str) -> Column:
    """``number`` as text where the year has four digits: ``date_format`` goes by
    a timestamp in the session's zone for every row, at many times the cost."""
    return F.when(F.year(d).between(1000, 9999), number.cast("string")).otherwise(F.date_format(d, form))


def yyyymmdd(d) -> Column:
    """``to_char(d, 'YYYYMMDD')`` of a date."""
    d = _c(d)
    return _digits(F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d), d, "yyyyMMdd")


def yyyymm(d) -> Column:
    """``to_char(d, 'YYYYMM')`` of a date."""
    d = _c(d)
    return _digits(F.year(d) * 100 + F.month(d), d, "yyyyMM")

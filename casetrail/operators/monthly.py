"""C10 monthly_counts: (month, case) rollup of the daily table with month-end
snapshot counts (semi-additive: only the month's last day, or ``as_of``)."""
from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_end, month_start, yyyymm
from ..functions.keys import joined
from .spine import ATTR_COLUMNS, SIDES, by_side, event_counts, in_stretches, intervals, one_if, rolled, span

MONTHLY_COLUMNS = [
    "month_id", "monthly_incident_id", "comment_id", "incident_id", "comment_seq",
    "comment_div", "comment_by", "comment_date", "ball_on", "elapsed_days",
    "elapsed_days_on_dev", "elapsed_days_on_field", "elapsed_days_on_unknown",
    "month_end_active_count", "month_end_active_count_dev",
    "month_end_active_count_field", "month_end_active_count_unknown",
    "comment_count", "registered_count", "patch_planned_count", "close_count",
    "close_count_normal", "close_count_force", "force_close_notice_count",
]
_ELAPSED = ["elapsed_days"] + [f"elapsed_days_on_{s}" for s in SIDES]
_ADDITIVE = ["comment_count", "registered_count", "patch_planned_count", "close_count",
             "close_count_normal", "close_count_force", "force_close_notice_count"]


def _month_sums(c, snap):
    def ind(pred):
        return F.when(pred, F.lit(1)).otherwise(F.lit(0))
    return [
        *[F.sum(x).alias(x) for x in _ELAPSED],
        F.sum(ind(snap)).alias("month_end_active_count"),
        *[F.sum(ind(snap & (c("ball_on") == s))).alias(f"month_end_active_count_{s}") for s in SIDES],
        *[F.sum(x).alias(x) for x in _ADDITIVE],
    ]


def _snapshot(as_of: _dt.date):
    c = F.col
    return (c("date_id") == F.least(month_end("date_id"), lit_date(as_of))) & (c("close_count") == 0)


#: Sides in the two lowest bits of a packed pick; 0 is any other.
_SIDE_CODES = {s: i + 1 for i, s in enumerate(SIDES)}
_MONTH = "INTERVAL 1 MONTH"
_SUMS = [*_ELAPSED, *_ADDITIVE, "_covered", "_closed"]


def monthly_from_intervals(lifecycle: DataFrame, calendar: DataFrame, as_of: _dt.date,
                           since: Column | None = None) -> DataFrame:
    """C10 straight from the entries' intervals, without a row per day."""
    return months_of(monthly_stretches(lifecycle, calendar, as_of, since)).select(*MONTHLY_COLUMNS)


def monthly_stretches(lifecycle: DataFrame, calendar: DataFrame, as_of: _dt.date, since: Column | None = None) -> DataFrame:
    """The rows of C10 by stretches of months [``month_id``, ``_to``], with the
    elapsed days of the first; ``months_of`` makes the months.

    An entry makes one row per stretch of months that it touches.  Elapsed days are the
    difference of dates (less the day that ends the interval), an entry counts where the
    month holds its own day, and the month-end snapshot asks whether the
    interval holds that day, whether any entry closes on it, and which side the highest
    seq on it is on (packed with the seq).  As for days, months inside an
    interval are final as they are made where the case's dates never fall; cases of
    one segment where they do are summed by stretches that the same entries
    cover, and only cases of several segments by months.
    ``since`` (the first day of a month) leaves out earlier months.
    """
    c = F.col
    base = intervals(lifecycle, calendar, as_of, since)
    first, last = month_start("_lo"), month_start("_hi")
    kept = ["incident_id", "comment_seq", *ATTR_COLUMNS]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    inside_first, inside_last = F.add_months(first, 1), F.add_months(last, -1)
    days = F.when(c("_until").isNotNull(), _month_days("month_id")).otherwise(zero)
    alone = (base.filter(c("_chain") & (inside_first <= inside_last))
             .select(*kept, "_until", inside_first.alias("month_id"), inside_last.alias("_to"))
             .withColumns({**{x: zero for x in _ADDITIVE}, **by_side("elapsed_days", days),
                           "_covered": one, "_closed": zero, "_snapshot": _packed_side()}))

    lo, hi = F.greatest("_lo", "month_id"), F.least(c("_hi"), F.last_day("month_id"))
    until_inside = F.coalesce(c("_until").between(lo, hi), F.lit(False))
    elapsed = F.when(c("_until").isNull(), zero).otherwise(F.datediff(hi, lo) + one - one_if(until_inside))
    snap = F.least(F.last_day("month_id"), lit_date(as_of))
    covers = snap.between(lo, hi)
    summed = [v.alias(k) for k, v in {
        **by_side("elapsed_days", elapsed), **event_counts(c("comment_date").between(lo, hi)),
        "_covered": one_if(covers), "_closed": one_if(covers & (c("comment_date") == snap) & c("is_final_closer")),
        "_snapshot": F.when(covers, _packed_side())}.items()]
    at, single = ["incident_id", "_seg", "month_id"], c("month_id").alias("_to")
    # what differs lies in an interval's first and last month
    m_first, m_last = month_number("_lo"), month_number("_hi")
    cuts = F.array(m_first, m_first + 1, m_last, m_last + 1)
    loose = (in_stretches(base.filter("not _split"), "month_id", F.array_distinct(F.array(span(m_first), span(m_last))), cuts,
                          m_first, m_last, month_numbered)
             .select(*kept, "_seg", "month_id", "_to", *summed))
    split = (base.filter("_split").select("*", F.explode(F.sequence(first, last, F.expr(_MONTH))).alias("month_id"))
             .select(*kept, "_seg", "month_id", single, *summed))
    names, most = ["month_id", "_to", *kept, *_SUMS, "_snapshot"], ["_snapshot"]
    parts = [alone, rolled(loose, at, _SUMS, most),
             rolled(rolled(split, at, _SUMS, most), ["incident_id", "month_id"], _SUMS, most)]
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])


def month_number(day) -> Column:
    """Months from January 1970."""
    return (F.year(day) - 1970) * 12 + F.month(day) - 1


def month_numbered(number: Column) -> Column:
    """The first day of a month by its number."""
    return F.add_months(lit_date(_dt.date(1970, 1, 1)), number)


def months_of(rows: DataFrame) -> DataFrame:
    """The months of ``monthly_stretches``, with the other columns of ``rows``."""
    c = F.col
    made = rows.withColumn("_from", c("month_id")).withColumn("month_id", F.explode(F.sequence("_from", "_to", F.expr(_MONTH))))
    # all entries cover all of a stretch of several months
    whole = {x: F.when(c("month_id") == c("_from"), c(x)).otherwise(
        (c(x) / _month_days("_from")).cast("bigint") * _month_days("month_id")) for x in _ELAPSED}
    active = (c("_covered") > 0) & (c("_closed") == 0)
    side = c("_snapshot").bitwiseAND(F.lit(3))
    counts = {"month_end_active_count": one_if(active),
              **{f"month_end_active_count_{s}": one_if(active & (side == i)) for s, i in _SIDE_CODES.items()}}
    return made.withColumns({**whole, **counts, "monthly_incident_id": joined(yyyymm("month_id"), c("incident_id"))})


def _month_days(month) -> Column:
    return F.dayofmonth(F.last_day(month)).cast("bigint")


def _packed_side() -> Column:
    """The seq, and the side in its lowest bits."""
    code = F.lit(0)
    for s, i in _SIDE_CODES.items():
        code = F.when(F.col("ball_on") == s, F.lit(i)).otherwise(code)
    return F.shiftleft(F.col("comment_seq").cast("long"), 2) + code


def monthly_counts(daily: DataFrame, as_of: _dt.date) -> DataFrame:
    """The last daily row of the month (by entry seq, then day) gives the
    attributes; elapsed and event counts add up; month-end counts are taken on
    ``least(month_end, as_of)`` for cases not closed that day."""
    c = F.col
    m = daily.withColumn("month_id", month_start("date_id"))
    last = F.max_by(F.struct("comment_id", "comment_seq", "comment_div", "comment_by",
                             "comment_date", "ball_on"),
                    F.struct("comment_seq", "date_id"))
    agg = m.groupBy("month_id", "incident_id").agg(last.alias("_last"), *_month_sums(c, _snapshot(as_of)))
    return agg.select(
        "month_id",
        joined(yyyymm("month_id"), c("incident_id")).alias("monthly_incident_id"),
        c("_last.comment_id").alias("comment_id"),
        "incident_id",
        c("_last.comment_seq").alias("comment_seq"),
        c("_last.comment_div").alias("comment_div"),
        c("_last.comment_by").alias("comment_by"),
        c("_last.comment_date").alias("comment_date"),
        c("_last.ball_on").alias("ball_on"),
        *MONTHLY_COLUMNS[9:],
    )

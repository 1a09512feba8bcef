"""C9 daily_counts: the daily interval spine and its per-(day, case) rollup.

The upstream model range-joins a calendar to entries on
``day >= entry_date and (day <= next_date or next_date is null)`` and finds
the last entry of each (day, case) with a lag/lead over a global order.  Here
each entry makes its own days (no join, no nested loop), clipped beforehand to
the calendar and to ``as_of``:

* a case whose dates never fall as seq rises has intervals that touch only at
  their end days.  Days inside an interval belong to its entry alone and are
  final as they are made: no aggregate, no sort, no shuffle;
* end days (two an entry at most) are summed per (case, segment, day), with the
  highest seq's attributes, where the entries lie;
* other cases of one segment are cut into stretches of days that the same entries
  cover, at every day where one begins or ends.  Stretches are summed like
  days and make their days afterwards, so the sort is of entries, not of days;
* only cases that span several segments are summed day by day, and once more per (case, day).
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import lit_date, yyyymmdd
from .lifecycle import PART_COLUMNS, SEGMENT_SIZE, segment_of

DAILY_COLUMNS = [
    "date_id", "daily_incident_id", "comment_id", "incident_id", "comment_seq",
    "comment_div", "comment_by", "comment_date", "ball_on", "elapsed_days",
    "elapsed_days_on_dev", "elapsed_days_on_field", "elapsed_days_on_unknown",
    "comment_count", "registered_count", "patch_planned_count", "close_count",
    "close_count_normal", "close_count_force", "force_close_notice_count",
]
COUNT_COLUMNS = DAILY_COLUMNS[9:]
SIDES = ["dev", "field", "unknown"]
ATTR_COLUMNS = ["comment_id", "comment_div", "comment_by", "comment_date", "ball_on"]


def intervals(lifecycle: DataFrame, calendar: DataFrame, as_of: _dt.date, since: Column | None = None) -> DataFrame:
    """Entries that are current on any day, with those days as [``_lo``, ``_hi``]
    and the day that ends them (``_until``, NULL while open).

    ``calendar`` must be contiguous (as built by ``fiscal_calendar``); only its
    first and last day are read, as scalar subqueries.  ``since`` leaves out
    the days before it, and with them the entries that end earlier.  A lifecycle without
    ``PART_COLUMNS`` is taken as cases that may span segments.
    """
    bounds = calendar.select(F.struct(F.min("date_id").alias("lo"),
                                      F.max("date_id").alias("hi"))).scalar()
    cal_lo, cal_hi = bounds.getField("lo"), bounds.getField("hi")
    asof, c = lit_date(as_of), F.col
    if PART_COLUMNS[0] not in lifecycle.columns:
        lifecycle = lifecycle.select("*", segment_of("comment_seq").alias("_seg"), F.lit(True).alias("_split"),
                                     F.lit(False).alias("_chain"))
    until = F.when(c("is_final_closer"), c("comment_date")).otherwise(c("next_comment_date"))
    lo = F.greatest(c("comment_date"), cal_lo, *([since] if since is not None else []))
    hi = F.least(F.coalesce(until, asof), asof, cal_hi)
    return (lifecycle.filter(~c("is_after_final_close") & c("comment_date").isNotNull() & cal_lo.isNotNull() & (lo <= hi))
            .select("incident_id", "comment_seq", *ATTR_COLUMNS, *PART_COLUMNS, "is_final_closer", "is_patch_planned",
                    "is_force_close_announce", "is_force_close", until.alias("_until"), lo.alias("_lo"), hi.alias("_hi")))


def one_if(pred: Column) -> Column:
    return F.when(pred, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def event_counts(on: Column) -> dict[str, Column]:
    """What an entry counts where its own day is (``on``)."""
    c = F.col
    return {
        "comment_count": one_if(on),
        "registered_count": one_if(on & (c("comment_seq") == 0)),
        "patch_planned_count": one_if(on & c("is_patch_planned")),
        "close_count": one_if(on & c("is_final_closer")),
        "close_count_normal": one_if(on & c("is_final_closer") & ~c("is_force_close")),
        "close_count_force": one_if(on & c("is_force_close")),
        "force_close_notice_count": one_if(on & c("is_force_close_announce")),
    }


def by_side(name: str, value: Column) -> dict[str, Column]:
    """``name`` and its share of each side."""
    zero = F.lit(0).cast("bigint")
    return {name: value, **{f"{name}_on_{s}": F.when(F.col("ball_on") == s, value).otherwise(zero) for s in SIDES}}


def rolled(rows: DataFrame, keys: list[str], sums: list[str], most: list[str] = []) -> DataFrame:
    """One row per ``keys``: the row with the highest seq, with the sums (and the
    maxima of ``most``) of all.  Rows that lie by some of the keys stay there."""
    # one order for rank and sums: they share a pass over the group
    group = Window.partitionBy(*keys).orderBy(F.col("comment_seq").desc())
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (rows.withColumns({"_rank": F.row_number().over(group), **{x: F.sum(x).over(whole) for x in sums},
                              **{x: F.max(x).over(whole) for x in most}})
            .filter("_rank = 1").drop("_rank"))


def daily_stretches(lifecycle: DataFrame, calendar: DataFrame, as_of: _dt.date) -> DataFrame:
    """The (day, case) rows by stretches of equal days [``date_id``, ``_to``]."""
    c = F.col
    base = intervals(lifecycle, calendar, as_of)
    kept = ["incident_id", "comment_seq", *ATTR_COLUMNS]
    day = F.expr("INTERVAL 1 DAY")
    starts, ends = c("_lo") == c("comment_date"), F.coalesce(c("_hi") == c("_until"), F.lit(False))
    lo, hi, own_day, end_day = (F.unix_date(x) for x in ("_lo", "_hi", "comment_date", "_until"))
    first, last = F.when(starts, F.date_add("_lo", 1)).otherwise(c("_lo")), F.when(ends, F.date_sub("_hi", 1)).otherwise(c("_hi"))
    zero = F.lit(0).cast("bigint")
    alone = (base.filter(c("_chain") & (first <= last))
             .select(*kept, "_until", first.alias("date_id"), last.alias("_to"))
             .withColumns({**{x: zero for x in COUNT_COLUMNS}, **by_side("elapsed_days", one_if(c("_until").isNotNull()))}))
    apart = ends & (c("_until") != c("comment_date"))
    end_days = F.when(starts & apart, F.array(span(lo), span(hi))).when(starts, F.array(span(lo))).when(apart, F.array(span(hi)))
    counts = {**by_side("elapsed_days", one_if(c("date_id") != c("_until"))), **event_counts(c("date_id") == c("comment_date"))}
    summed = [v.alias(k) for k, v in counts.items()]
    at, names = ["incident_id", "_seg", "date_id"], ["date_id", "_to", *kept, *COUNT_COLUMNS]
    cuts = F.array(lo, hi + 1, own_day, own_day + 1, end_day, end_day + 1)
    whole = in_stretches(base.filter("not _split"), "date_id", end_days, cuts, lo, hi, F.date_from_unix_date)
    whole = rolled(whole.select(*kept, "_seg", "date_id", "_to", *summed), at, COUNT_COLUMNS)
    split = base.filter("_split").select("*", F.explode(F.sequence("_lo", "_hi", day)).alias("date_id"))
    split = rolled(split.select(*kept, "_seg", "date_id", c("date_id").alias("_to"), *summed), at, COUNT_COLUMNS)
    split = rolled(split, ["incident_id", "date_id"], COUNT_COLUMNS)
    return alone.select(*names).unionByName(whole.select(*names)).unionByName(split.select(*names))


#: A stretch in one long: its first number above these bits, and how many follow it.
_SPAN_BITS = 32


def span(first: Column, more: Column | None = None) -> Column:
    """The stretch of ``first`` and ``more`` numbers behind it."""
    packed = F.shiftleft(first.cast("long"), _SPAN_BITS)
    return packed if more is None else packed + more


def in_stretches(base: DataFrame, name: str, own: Column, cuts: Column, lo: Column, hi: Column,
                 dated: Callable[[Column], Column]) -> DataFrame:
    """One row per entry and stretch [``name``, ``_to``] of days or months that it covers
    between ``lo`` and ``hi``.  Both are numbers, as are ``cuts``, and ``dated`` makes dates
    of them.  A (case, segment) is cut at all ``cuts`` of its entries, which hold ``lo``,
    what follows ``hi``, and both ends of all that differs from its surroundings, so what
    holds at a stretch's start holds on all of it.  There are no more stretches than days
    or months.  Cases whose dates never fall give the spans ``own`` only.

    The spans of a case are made once, and an entry's are a slice of them: no lambda runs
    per entry, so the expansion is compiled together with its neighbours."""
    c = F.col
    marks = (base.filter("not _chain").groupBy("incident_id", "_seg")
             .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.array_compact(cuts))))).alias("_marks")))
    # the last mark lies behind all intervals, so it opens no stretch
    spans = F.transform("_marks", lambda m, i: span(m, F.get("_marks", i + 1) - 1 - m))
    marks = marks.select("incident_id", "_seg", "_marks", spans.alias("_spans"))
    first = F.array_position("_marks", lo)
    inside = F.slice("_spans", first.cast("int"), (F.array_position("_marks", hi + 1) - first).cast("int"))
    met = base.join(marks.hint("merge"), ["incident_id", "_seg"], "left")  # rows without a case meet no marks
    singles = F.sequence(span(lo), span(hi), F.lit(1 << _SPAN_BITS))
    kept = [c(x) for x in base.columns]
    made = met.select(*kept, F.explode(F.when(c("_chain"), own).when(c("_marks").isNull(), singles).otherwise(inside)).alias(name))
    start, more = F.shiftright(name, _SPAN_BITS).cast("int"), c(name).bitwiseAND(F.lit((1 << _SPAN_BITS) - 1)).cast("int")
    return made.select(*kept, dated(start).alias(name), dated(start + more).alias("_to"))


def daily_counts(lifecycle: DataFrame, calendar: DataFrame, as_of: _dt.date) -> DataFrame:
    """One row per (day, case); last-entry attributes + 11 day sums.

    Pass the lifecycle with ``PART_COLUMNS`` (``entry_lifecycle(..., parts=True)``)
    for rows that stay where they lie; without them every day of every case is
    summed in both steps.
    """
    day = F.expr("INTERVAL 1 DAY")
    made = daily_stretches(lifecycle, calendar, as_of).withColumnRenamed("date_id", "_from")
    made = made.withColumn("date_id", F.explode(F.sequence("_from", "_to", day)))
    # all days lie in the calendar: their texts are made once, and looked up by place
    texts = F.transform(F.sequence("lo", "hi", day), lambda d: F.concat(yyyymmdd(d), F.lit("_")))
    bounds = calendar.agg(F.min("date_id").alias("lo"), F.max("date_id").alias("hi"))
    known = bounds.select(F.struct("lo", texts.alias("texts")).alias("days")).scalar()
    text = F.get(known.getField("texts"), F.datediff("date_id", known.getField("lo")))
    return made.select(
        "date_id", F.concat(text, "incident_id").alias("daily_incident_id"),
        "comment_id", "incident_id", "comment_seq", "comment_div", "comment_by", "comment_date",
        "ball_on", *COUNT_COLUMNS)

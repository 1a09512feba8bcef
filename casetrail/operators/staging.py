"""C4 stage_cases and C5 stage_entries (comment ids + direct-close synthesis)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.keys import entry_id
from ..sources.schemas import CASE_KEYS, ENTRY_KEYS
from .common import small_side
from .overlay import overlay

STAGED_ENTRY_COLUMNS = ["comment_id", "incident_id", "comment_seq", "comment_div",
                        "comment_by", "comment_date", "comment"]


def _overlaid(base: DataFrame, before: DataFrame | None, after: DataFrame | None, keys) -> DataFrame:
    """C3 when corrections are given; no corrections -> the base as is."""
    if before is None and after is None:
        return base
    return overlay(base, before, after, keys)


def stage_cases(base: DataFrame, before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """C4: overlay + ``has_library_change``."""
    staged = _overlaid(base, before, after, CASE_KEYS)
    return staged.withColumn("has_library_change", TX.has_library_change("description"))


#: Bits of a packed day, and what is added to a day number: 1 is the first day of
#: year 0001, 0 stands for no date.
DAY_BITS, DAY_ZERO = 22, 719_163


def _packed_last(seq: str, date: str, ends: Column) -> Column:
    """seq, day and flag in one long that sorts by seq first."""
    day = F.coalesce(F.unix_date(date) + DAY_ZERO, F.lit(0)).cast("long")
    return F.shiftleft(F.col(seq).cast("long"), DAY_BITS + 1) + 2 * day + ends.cast("long")


def direct_close_entries(entries: DataFrame, cases: DataFrame, types: DataFrame) -> DataFrame:
    """Synthesised closing entries for cases closed without a closing entry.

    A case with ``close_date`` on or after the date of its last entry (highest
    seq), whose last entry is neither closer nor approver (or of a type absent
    from the master), gets entry ``last + 1`` dated ``close_date``.

    What is asked of the last entry (its seq, its date, whether its type ends a
    case) is packed into one long, so the pick is a hash aggregate, combined
    map-side: a case with a large share of all entries never lands in one task.
    """
    m = small_side(types, F.col("comment_div").alias("_m_div"),
                   F.coalesce(F.col("is_closer") | F.col("is_approver"), F.lit(True)).alias("_m_ends"))
    typed = entries.select("incident_id", "comment_seq", "comment_div", "comment_date")
    last = (typed.join(m, F.col("comment_div") == F.col("_m_div"), "left").groupBy("incident_id")
            .agg(F.max(_packed_last("comment_seq", "comment_date", F.coalesce("_m_ends", F.lit(False)))).alias("_last")))
    day = F.shiftright("_last", 1).bitwiseAND(F.lit((1 << DAY_BITS) - 1)).cast("int")
    c = (cases.select("incident_id", "close_date")
         .filter(F.col("close_date").isNotNull())
         .join(last, "incident_id")
         .filter((F.col("_last").bitwiseAND(F.lit(1)) == 0) & (day > 0)
                 & (F.col("close_date") >= F.date_from_unix_date(day - DAY_ZERO))))
    seq = (F.shiftright("_last", DAY_BITS + 1) + 1).cast("int")
    return c.select(
        entry_id("incident_id", seq).alias("comment_id"),
        "incident_id",
        seq.alias("comment_seq"),
        F.lit(TX.DIRECT_CLOSE_TYPE).alias("comment_div"),
        F.lit(TX.DIRECT_CLOSE_BY).alias("comment_by"),
        F.col("close_date").alias("comment_date"),
        F.lit(TX.DIRECT_CLOSE_TEXT).alias("comment"),
    )


def stage_entries(base: DataFrame, before: DataFrame | None, after: DataFrame | None,
                  cases: DataFrame, types: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda _, df: df) -> DataFrame:
    """Overlay, ``comment_id``, then real entries plus direct-close entries.

    ``keep(name, df)`` may store what the result reads more than once: the
    overlaid entries and the direct-close ones."""
    staged = _overlaid(base, before, after, ENTRY_KEYS)
    keyed = staged.select(entry_id("incident_id", "comment_seq").alias("comment_id"),
                          "incident_id", "comment_seq", "comment_div", "comment_by",
                          "comment_date", "comment")
    keyed = keep("overlaid", keyed)
    return keyed.unionByName(keep("direct", direct_close_entries(keyed, cases, types))).select(*STAGED_ENTRY_COLUMNS)

"""Marts over the case rollup, the monthly counts and the dimensions."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import first_date_of_fiscal_scope, lit_date
from .monthly import months_of

# Upstream default: two fiscal years of monthly history, counting the current one.
MART_SCOPE_YEARS = 2

ACTIVE_COLUMNS = [
    "incident_id", "title", "incident_div", "category", "category2", "category3",
    "hospital", "registered_by", "registered_date", "impact", "impact_by_register",
    "assigned_to", "is_assigned_to_dwh", "status", "ball_on", "first_response_date",
    "closed_date", "approved_date", "last_comment_date", "last_updated_date", "patch_no",
    "has_patch_no", "has_patch_comment", "has_force_close_announce", "has_force_close",
    "has_library_change", "days_before_first_response", "days_on_developer",
    "days_on_field", "days_on_unknown", "server", "version", "version_ehr", "critical",
    "event", "event_date", "external_case_id", "additional_item1", "additional_item2",
    "additional_item3", "additional_item4", "related_incident",
]
_CASE_SIDE = ["title", "incident_div", "category", "hospital", "impact", "impact_by_register",
              "registered_date", "closed_date", "assigned_to", "is_assigned_to_dwh", "status",
              "has_patch_no", "has_patch_comment", "has_force_close_announce", "has_force_close",
              "has_library_change"]
_MONTH_SIDE = ["incident_id", "comment_id", "comment_seq", "comment_div", "comment_by",
               "comment_date", "ball_on", "elapsed_days", "elapsed_days_on_dev",
               "elapsed_days_on_field", "elapsed_days_on_unknown", "month_end_active_count",
               "month_end_active_count_dev", "month_end_active_count_field",
               "month_end_active_count_unknown", "comment_count", "registered_count",
               "patch_planned_count", "close_count", "close_count_normal", "close_count_force",
               "force_close_notice_count"]
MART_MONTHLY_COLUMNS = ["month_id", "monthly_incident_id"] + _CASE_SIDE + _MONTH_SIDE


def active_cases(rollup: DataFrame) -> DataFrame:
    """C11: cases with no final close (cases without entries count as active)."""
    return rollup.filter(F.col("closed_date").isNull()).select(*ACTIVE_COLUMNS)


def scope_start(as_of: _dt.date, scope_years: int = MART_SCOPE_YEARS) -> Column:
    """P10: the first day that the mart shows."""
    return first_date_of_fiscal_scope(lit_date(as_of), scope_years)


def mart_monthly(monthly: DataFrame, rollup: DataFrame, as_of: _dt.date,
                 scope_years: int = MART_SCOPE_YEARS) -> DataFrame:
    """Monthly facts in the fiscal scope joined to the case attributes.

    The scope filter sits on the monthly side, below the join.  Months that are
    made for this mart alone should start at ``scope_start`` (``since`` of
    ``monthly_from_intervals``): then no earlier month is made at all.  The
    case side is projected to the 17 columns it gives.  ``monthly_stretches`` may
    be given instead of months: they meet their cases first and make their
    months afterwards, so no row per month is moved or sorted.
    """
    first, stretched = scope_start(as_of, scope_years), "_to" in monthly.columns
    t1 = monthly.filter(F.col("_to" if stretched else "month_id") >= first)
    t2 = rollup.select("incident_id", *_CASE_SIDE).withColumnRenamed("incident_id", "_case_id")
    j = t1.join(t2, t1["incident_id"] == t2["_case_id"], "inner")
    if stretched:
        j = months_of(j).filter(F.col("month_id") >= first)
    return j.select(*MART_MONTHLY_COLUMNS)


def dim_calendar(calendar: DataFrame) -> DataFrame:
    """Pass-through."""
    return calendar


def dim_entry_type(types: DataFrame) -> DataFrame:
    """Pass-through."""
    return types

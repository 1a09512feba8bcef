"""C7 case_rollup: per-case figures from the entry lifecycle joined to the header."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between
from .common import coded, small_side

ROLLUP_COLUMNS = [
    "incident_id", "title", "incident_div", "category", "category2", "category3",
    "hospital", "registered_by", "registered_by_org", "registered_date", "impact",
    "impact_by_register", "assigned_to", "assigned_to_org", "is_assigned_to_dwh",
    "status", "status_org", "ball_on", "first_response_date", "first_response_date_org",
    "closed_date", "closed_date_org", "approved_date", "approved_date_org",
    "last_comment_date", "last_updated_date", "patch_no", "has_patch_no",
    "has_patch_comment", "has_force_close_announce", "has_force_close",
    "has_library_change", "days_before_first_response", "days_on_developer",
    "days_on_field", "days_on_unknown", "server", "version", "version_ehr",
    "critical", "event", "event_date", "external_case_id", "additional_item1",
    "additional_item2", "additional_item3", "additional_item4", "related_incident",
]


def entry_figures(lifecycle: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """One row per case (partial + final aggregation, skew-tolerant).

    With the type master, the last entry's type is picked as its number and turned back
    into type and side once per case, so that the aggregate holds fixed-size values only
    and hashes; without one (or with one too large), texts are picked.
    """
    c = F.col
    days = c("days_after_comment")
    codes = coded(types, ["comment_div", "ball_on"]) if types is not None else None
    if codes is not None:
        k = codes.select(c("comment_div").alias("_k_div"), F.coalesce("ball_on", F.lit("unknown")).alias("_k_ball"), "_code")
        k._casetrail_checked = codes._casetrail_checked
        k = small_side(k)
        lifecycle = lifecycle.join(k, (c("comment_div") == c("_k_div")) & (c("ball_on") == c("_k_ball")), "left")
        picks = [F.max(F.when(c("is_last_comment"), F.coalesce("_code", F.lit(-1)))).alias("_last_code")]
    else:
        picks = [F.max(F.when(c("is_last_comment"), c("comment_div"))).alias("status_by_comment"),
                 F.max(F.when(c("is_last_comment"), c("ball_on"))).alias("_last_ball_on")]
    figures = lifecycle.groupBy("incident_id").agg(
        F.min(F.when(c("is_first_response"), c("comment_date"))).alias("first_response_date_by_comment"),
        F.max(F.when(c("is_final_closer"), c("comment_date"))).alias("close_date_by_comment"),
        F.max(F.when(c("is_final_approver"), c("comment_date"))).alias("approved_date_by_comment"),
        F.max("comment_date").alias("last_comment_date"),
        F.bool_or("is_patch_planned").alias("has_patch"),
        F.bool_or("is_force_close_announce").alias("has_force_close_announce"),
        F.bool_or(c("is_force_close") & c("is_final_closer")).alias("has_force_close"),
        F.sum(F.when(c("ball_on") == "dev", days).otherwise(0)).alias("days_on_developer"),
        F.sum(F.when(c("ball_on") == "field", days).otherwise(0)).alias("days_on_field"),
        F.sum(F.when(c("ball_on") == "unknown", days).otherwise(0)).alias("days_on_unknown"),
        *picks,
    )
    if codes is None:
        return figures
    # an unknown type is 'others' on side 'unknown'; a case without entries has neither
    known = F.col("_last_code").isNotNull()
    return (figures.join(k.withColumnRenamed("_code", "_last_code"), "_last_code", "left")
            .withColumn("status_by_comment", F.when(known, F.coalesce("_k_div", F.lit("others"))))
            .withColumn("_last_ball_on", F.when(known, F.coalesce("_k_ball", F.lit("unknown")))))


def case_rollup(cases: DataFrame, lifecycle: DataFrame, aliases: DataFrame,
                members: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """48 columns per case.

    Upstream quirk kept on purpose (N1): the registrant's adjusted name is taken
    from the alias row matched on the *assignee*; the registrant's own alias row
    is never read.  Cases without entries keep NULL entry figures.
    """
    figs = entry_figures(lifecycle, types)
    t = cases.join(figs, "incident_id", "left")
    a = small_side(aliases, F.col("user_name").alias("_a_name"), F.col("user_name_adjusted").alias("_a_adjusted"))
    t = t.join(a, t["assigned_to"] == a["_a_name"], "left")
    t = (t.withColumn("_registered_by_adj", F.coalesce("_a_adjusted", "registered_by"))
          .withColumn("_assigned_to_adj", F.coalesce("_a_adjusted", "assigned_to")))
    mem = small_side(members, F.col("user_name").alias("_mem_name"))
    t = t.join(mem, t["_assigned_to_adj"] == mem["_mem_name"], "left")
    c = F.col
    return t.select(
        "incident_id", "title", "incident_div", "category", "category2", "category3", "hospital",
        c("_registered_by_adj").alias("registered_by"),
        c("registered_by").alias("registered_by_org"),
        "registered_date", "impact", "impact_by_register",
        c("_assigned_to_adj").alias("assigned_to"),
        c("assigned_to").alias("assigned_to_org"),
        (c("_mem_name").isNotNull() | c("assigned_to").isNull()).alias("is_assigned_to_dwh"),
        c("status_by_comment").alias("status"),
        c("status").alias("status_org"),
        c("_last_ball_on").alias("ball_on"),
        c("first_response_date_by_comment").alias("first_response_date"),
        c("first_response_date").alias("first_response_date_org"),
        c("close_date_by_comment").alias("closed_date"),
        c("close_date").alias("closed_date_org"),
        c("approved_date_by_comment").alias("approved_date"),
        c("approved_date").alias("approved_date_org"),
        "last_comment_date", "last_updated_date", "patch_no",
        c("patch_no").isNotNull().alias("has_patch_no"),
        c("has_patch").alias("has_patch_comment"),
        "has_force_close_announce", "has_force_close", "has_library_change",
        days_between("first_response_date_by_comment", "registered_date").alias("days_before_first_response"),
        "days_on_developer", "days_on_field", "days_on_unknown",
        "server", "version", "version_ehr", "critical", "event", "event_date",
        "external_case_id", "additional_item1", "additional_item2", "additional_item3",
        "additional_item4", "related_incident",
    )

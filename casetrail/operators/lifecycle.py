"""C6 entry_lifecycle: entry types, per-case sequence bounds, lifecycle flags,
author aliases, next-entry date and the force-close wording flags.

Skew: a case may hold a large share of all entries.  Entries are therefore
cut into *segments* of at most ``segment_size`` consecutive sequence numbers
(``comment_seq`` is the per-case key, so a segment never holds more rows than
that).  Per-segment figures are pre-aggregated map-side, folded per case on the
small segment table, and joined back on (case, segment).  The ``lead`` runs
within a segment and takes the next segment's first date at the boundary.  So
the only shuffle of entry rows is hash-partitioned by (case, segment), and no
task ever holds more than one segment of one case.  Entries that already lie
by (case, segment), with their segment in ``_seg``, are not shuffled at all.

The wording flags are computed where the text is read.  Whoever does not ask for
``comment`` moves no texts: they are pruned below the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.dates import days_between
from .common import small_side

# Entries per segment; with an int sequence a case has at most 2^32 / 2^16
# segments, which bounds the per-case window over the segment table too.
SEGMENT_SIZE = 1 << 16

LIFECYCLE_COLUMNS = [
    "comment_id", "incident_id", "comment_seq", "comment_div", "comment_div_org",
    "comment_by", "comment_by_org", "comment_date", "next_comment_date",
    "days_after_comment", "ball_on", "is_first_response", "is_closer",
    "is_final_closer", "is_after_final_close", "is_approver", "is_final_approver",
    "is_last_comment", "is_patch_planned", "is_force_close_announce",
    "is_force_close", "comment",
]


def with_entry_types(entries: DataFrame, types: DataFrame) -> DataFrame:
    """Left join the type master; unknown types -> 'others' / 'unknown' / false."""
    m = small_side(
        types, F.col("comment_div").alias("_m_div"), F.col("ball_on").alias("_m_ball_on"),
        F.col("is_closer").alias("_m_closer"), F.col("is_approver").alias("_m_approver"),
        F.col("is_patch_planned").alias("_m_patch"), F.col("is_response").alias("_m_response"))
    j = entries.join(m, entries["comment_div"] == m["_m_div"], "left")
    return j.select(
        *[F.col(c) for c in entries.columns],
        F.coalesce("_m_div", F.lit("others")).alias("comment_div_adjusted"),
        F.coalesce("_m_ball_on", F.lit("unknown")).alias("ball_on"),
        F.coalesce("_m_closer", F.lit(False)).alias("is_closer"),
        F.coalesce("_m_approver", F.lit(False)).alias("is_approver"),
        F.coalesce("_m_patch", F.lit(False)).alias("is_patch_planned"),
        F.coalesce("_m_response", F.lit(False)).alias("is_response"),
    )


def _flag(pred) -> F.Column:
    """``case when pred then true else false end``."""
    return F.coalesce(pred, F.lit(False))


#: What the spine and the months ask of an entry besides the lifecycle columns:
#: its segment, whether its case spans several, and whether the case's dates never fall as seq
#: rises (said of single-segment cases only).
PART_COLUMNS = ["_seg", "_split", "_chain"]


def segment_of(seq, segment_size: int = SEGMENT_SIZE) -> Column:
    return F.floor((F.col(seq) if isinstance(seq, str) else seq) / F.lit(segment_size)).cast("int")


#: Bytes of texts from which a segment is cut further, and the entries that a cut keeps together.
SEGMENT_BYTES, FINE = 64 << 20, 64


def with_segments(entries: DataFrame, segment_size: int = SEGMENT_SIZE, max_bytes: int = SEGMENT_BYTES,
                  fine: int = FINE) -> DataFrame:
    """``_seg``, ascending with seq inside a case: at most ``segment_size``
    consecutive numbers, and about ``max_bytes`` of texts, whichever is reached first.

    Sizes are summed map-side per (case, segment).  Only segments over the limit
    are cut, at multiples of ``fine`` numbers, by the running sum of their sizes;
    where there is none, which one row tells, a segment follows from its seq alone.
    """
    seq, cuts = F.col("comment_seq"), -(-segment_size // fine) + 1
    rows = entries.withColumn("_seg", segment_of(seq, segment_size))
    sizes = rows.groupBy("incident_id", "_seg").agg(F.sum(F.coalesce(F.octet_length("comment"), F.lit(0))).alias("_bytes"))
    large = sizes.filter(F.col("_bytes") > max_bytes)
    numbered = (F.col("_seg") * cuts).cast("int")
    if large.isEmpty():
        return rows.withColumn("_seg", numbered)
    part = F.floor(seq / F.lit(fine)).cast("int")
    per_part = (rows.join(large.select("incident_id", "_seg"), ["incident_id", "_seg"], "left_semi")
                .groupBy("incident_id", "_seg", part.alias("_part")).agg(F.sum(F.coalesce(F.octet_length("comment"), F.lit(0))).alias("_b")))
    segment = Window.partitionBy("incident_id", "_seg")
    before = segment.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = per_part.withColumn("_full", F.floor((F.sum("_b").over(before) - F.col("_b")) / max_bytes))
    # no more cuts than parts, so that the numbers of one segment stay below the next one's
    cut = small_side(filled.select(F.col("incident_id").alias("_c_case"), F.col("_seg").alias("_c_seg"), F.col("_part").alias("_c_part"),
                                   (F.dense_rank().over(segment.orderBy("_full")) - 1).alias("_cut")))
    j = rows.withColumn("_part", part)
    j = j.join(cut, j["incident_id"].eqNullSafe(cut["_c_case"]) & (j["_seg"] == cut["_c_seg"]) & (j["_part"] == cut["_c_part"]), "left")
    return (j.withColumn("_seg", numbered + F.coalesce("_cut", F.lit(0))).drop("_part", "_c_case", "_c_seg", "_c_part", "_cut"))


def entry_lifecycle(entries: DataFrame, types: DataFrame, aliases: DataFrame,
                    segment_size: int = SEGMENT_SIZE, parts: bool = False) -> DataFrame:
    """C6 over staged entries (``comment_id`` ... ``comment``); 22 columns out.

    ``parts`` appends ``PART_COLUMNS`` (no extra pass): they let the daily spine
    tell single-segment cases from split ones, and days that only one entry can
    cover from shared ones.  Entries may bring their ``_seg`` (``with_segments``).
    """
    seq = F.col("comment_seq")
    if "_seg" not in entries.columns:
        entries = entries.withColumn("_seg", segment_of(seq, segment_size))
    e = with_entry_types(entries, types).withColumns({
        "is_force_close_announce": TX.is_force_close_announce("comment"),
        "is_force_close": TX.is_force_close("comment")})

    # A2 per segment (partial aggregation before the shuffle).
    seg = e.groupBy("incident_id", "_seg").agg(
        F.max(seq).alias("_s_max"),
        F.min(F.when(F.col("is_response"), seq)).alias("_s_min_resp"),
        F.max(F.when(~F.col("is_approver"), seq)).alias("_s_max_no_appr"),
        F.max(F.when(~(F.col("is_closer") | F.col("is_approver")), seq)).alias("_s_max_no_close"),
        F.min_by("comment_date", seq).alias("_s_first_date"),
    )
    # A2 per case, folded over the (small) segment table.
    case_w = Window.partitionBy("incident_id")
    seg = seg.select(
        "incident_id", "_seg",
        F.max("_s_max").over(case_w).alias("_last_seq"),
        F.min("_s_min_resp").over(case_w).alias("_min_seq_resp"),
        F.max("_s_max_no_appr").over(case_w).alias("_max_seq_no_appr"),
        F.max("_s_max_no_close").over(case_w).alias("_max_seq_no_close"),
        F.lead("_s_first_date").over(case_w.orderBy("_seg")).alias("_next_seg_first_date"),
        (F.min("_seg").over(case_w) < F.max("_seg").over(case_w)).alias("_several"),
    )

    j = e.join(seg, ["incident_id", "_seg"], "left")
    in_seg = Window.partitionBy("incident_id", "_seg").orderBy(seq)
    raw_next = F.when(F.lead(seq).over(in_seg).isNull(), F.col("_next_seg_first_date")) \
        .otherwise(F.lead("comment_date").over(in_seg))

    closing = F.col("is_closer") | F.col("is_approver")
    flagged = j.select(
        *[F.col(c) for c in e.columns if not c.startswith("_")],
        _flag(seq == F.col("_min_seq_resp")).alias("is_first_response"),
        _flag(closing & (seq == F.col("_max_seq_no_close") + 1)).alias("is_final_closer"),
        _flag(seq > F.col("_max_seq_no_close") + 1).alias("is_after_final_close"),
        _flag(F.col("is_approver") & (seq == F.col("_max_seq_no_appr") + 1)).alias("is_final_approver"),
        _flag(seq == F.col("_last_seq")).alias("is_last_comment"),
        raw_next.alias("_raw_next"),
        "_several", "_seg",
    )

    # Author aliases.
    a = small_side(aliases, F.col("user_name").alias("_a_name"), F.col("user_name_adjusted").alias("_a_adjusted"))
    flagged = flagged.join(a, flagged["comment_by"] == a["_a_name"], "left")

    final_close = F.col("is_final_closer") | F.col("is_final_approver")
    next_date = F.when(final_close, F.coalesce("_raw_next", "comment_date")).otherwise(F.col("_raw_next"))
    split = F.coalesce("_several", F.lit(True))
    rising = F.col("is_last_comment") | (next_date.isNotNull() & (next_date >= F.col("comment_date")))
    chain = F.bool_and(_flag(rising)).over(Window.partitionBy("incident_id", "_seg"))
    return flagged.select(
        "comment_id", "incident_id", "comment_seq",
        F.col("comment_div_adjusted").alias("comment_div"),
        F.col("comment_div").alias("comment_div_org"),
        F.coalesce("_a_adjusted", "comment_by").alias("comment_by"),
        F.col("comment_by").alias("comment_by_org"),
        "comment_date",
        next_date.alias("next_comment_date"),
        days_between(next_date, F.col("comment_date")).alias("days_after_comment"),
        "ball_on", "is_first_response", "is_closer", "is_final_closer",
        "is_after_final_close", "is_approver", "is_final_approver", "is_last_comment",
        "is_patch_planned",
        "is_force_close_announce", "is_force_close", "comment",
        *(["_seg", split.alias("_split"), (chain & ~split).alias("_chain")] if parts else []),
    )

"""Adapters from the driver's tables to the case / entry model.

* events -> cases keyed by ``user_id``, one entry per event (``EV-``)
* orders -> cases keyed by ``o_custkey``, one entry per order (``CU-``); the
  long multi-year spine
* conversations -> one history cell per turn, meta suffixes after each
  sentence-ending line (``CV-``), input of the history splitter

Everything is derived by Spark from the given tables, so the work grows with
them.  The masters below are fixed, small and part of each adapter's setup.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import padded
from ..functions.text import LIBRARY_MARK, LIBRARY_PHRASE
from ..sources.layers import drop_layers, layer, snapshot
from ..sources.schemas import ALIASES, CASE_COLUMNS, ENTRY_TYPES, MEMBERS, spark_type
from ..operators.common import known_small
from .warehouse import Inputs

EVENTS_AS_OF = _dt.date(2024, 2, 15)
ORDERS_AS_OF = _dt.date(2001, 12, 31)
HISTORY_EPOCH = _dt.date(2024, 1, 1)

# Fixed adapter masters: entry type -> side and flags (closer, approver,
# patch planned, response).  'error' events are deliberately left out.
EVENT_TYPES = [
    ("signup", "dev", False, True, False, False),
    ("view", "dev", False, False, True, True),
    ("click", "field", False, False, False, True),
    ("purchase", "field", True, False, False, True),
]
ORDER_TYPES = [
    ("F", "field", True, False, False, True),
    ("O", "dev", False, False, False, True),
    ("P", "dev", False, False, True, False),
]
EVENT_ALIASES = [
    ("person0003", "person0001"),
    ("person0011", "person0001"),
    ("person0042", "person0007"),
    ("person0100", "person0007"),
]
ORDER_ALIASES = [
    ("1-URGENT", "2-HIGH"),
    ("person0003", "person0001"),
]
MEMBER_NAMES = ["person0001", "person0002", "person0005", "person0007", "person0010",
                "person0020"]
# Close date relative to the last entry date, by customer segment (NULL = open).
CLOSE_OFFSET_BY_SEGMENT = [("AUTOMOBILE", -1), ("BUILDING", 0), ("FURNITURE", 1), ("HOUSEHOLD", 2)]


# Wording appended to texts where key % divisor = remainder, so that the text
# predicates (P5, F15) meet rows that hold them and rows that don't.
EVENT_WORDING = [
    (3, 0, "\nご連絡がないため、\nクローズします。\n新規QA登録をお願いします。"),
    (97, 1, "\nその後の状況について\nご回答が無い場合はクローズします。"),
]
CASE_WORDING = [(4, 0, "\n" + LIBRARY_MARK + "\n" + LIBRARY_PHRASE), (4, 1, "\n" + LIBRARY_PHRASE)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The tables that an adapter reads.
READS = {"events": ["events", "customer"], "orders": ["orders", "customer"], "conversations": ["conversations"]}


def run_id(spark: SparkSession, sf_dir: str, adapter: str) -> str:
    """Names the stored layers of one state of the adapter's tables."""
    return f"{adapter}_{snapshot(spark, *(f'{sf_dir.rstrip('/')}/{t}.parquet' for t in READS[adapter]))}"


def masters(spark: SparkSession, types: Sequence[tuple], aliases: Sequence[tuple]):
    """The fixed masters as frames; their row counts are known, so they are
    marked broadcastable without a counting job."""
    return (known_small(spark.createDataFrame(list(types), ENTRY_TYPES), len(types)),
            known_small(spark.createDataFrame(list(aliases), ALIASES), len(aliases)),
            known_small(spark.createDataFrame([(n,) for n in MEMBER_NAMES], MEMBERS), len(MEMBER_NAMES)))


def seq_within_case(df: DataFrame, case_col: str, day_col: str, order: Sequence[Column], name: str) -> DataFrame:
    """Dense 0-based rank per case, ordered by ``day_col`` then ``order``
    (NULLs last, as in SQL), without ever ranking a whole case in one task.

    Rows are range-partitioned and sorted on (case, day, order...), so even one
    hot day of one case spreads over consecutive partitions, and stored as a
    table with their place (partition and position in it): range
    sampling is seeded per plan, so two readers of one range shuffle could disagree.
    The ranked rows are stored as table ``name`` in its stead, once ranks are known.
    A case's rows lie in a row inside a partition.  A rank is a row's place less
    that of the case's first row in its partition, plus the case's rows in earlier partitions: a
    window over one row per (case, partition).  No row is sorted or ranked again.
    """
    keys = [F.col(case_col).asc_nulls_last(), F.col(day_col).asc_nulls_last(), *order]

    def placed() -> DataFrame:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn("_at", F.monotonically_increasing_id()))

    def ranked() -> DataFrame:
        # an id is the partition, 33 bits to the left, and the position in it
        part = layer(df.sparkSession, f"{name}_placed", placed).withColumn("_part", F.shiftright("_at", 33))
        runs = part.groupBy(case_col, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(case_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        starts = runs.select(F.col(case_col).alias("_o_case"), F.col("_part").alias("_o_part"),
                             (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_zero"))
        j = part.join(starts, part[case_col].eqNullSafe(starts["_o_case"]) & (part["_part"] == starts["_o_part"]), "inner")
        return j.withColumn("comment_seq", (F.col("_at") - F.col("_zero")).cast("int")) \
            .drop("_o_case", "_o_part", "_zero", "_part", "_at")

    # the corrections read the ranked rows many times: they meet their starts once
    out = layer(df.sparkSession, name, ranked)
    drop_layers(df.sparkSession, f"{name}_placed")
    return out


# Corrections (C3) by rules on the data, at both levels.
# Cases of hospital 3 come back corrected, those of 7 are withdrawn, and those
# of 5 get a twin without entries (an ``after`` row whose key is new).
CORRECTED_HOSPITAL, WITHDRAWN_HOSPITAL, TWINNED_HOSPITAL = "3", "7", "5"
# Entries on days 3, 10, 17, 24 and 31 of a month are withdrawn; those on day 3 and 17 come back a day later
# with another author; a case's entry 4 gets a copy behind the case's last one.
WITHDRAWN_DAY, CORRECTED_DAY, COPIED_SEQ = (7, 3), (14, 3), 4


def case_corrections(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(before, after) of the case headers."""
    hospital = F.col("hospital")
    before = cases.filter(hospital.isin(CORRECTED_HOSPITAL, WITHDRAWN_HOSPITAL))
    corrected = cases.filter(hospital == CORRECTED_HOSPITAL).withColumns({
        "title": F.concat("title", F.lit(" (corrected)")), "close_date": F.date_add("close_date", 9),
        "description": F.concat(F.coalesce("description", F.lit("")), F.lit("\n" + LIBRARY_MARK + "\n" + LIBRARY_PHRASE)),
        "assigned_to": F.lit(None).cast("string")})
    twins = cases.filter(hospital == TWINNED_HOSPITAL).withColumn("incident_id", F.concat("incident_id", F.lit("-B")))
    return before, corrected.unionByName(twins)


def entry_corrections(entries: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(before, after) of the entries; ``sizes`` has each case's number of entries (``_n``)."""
    day = F.dayofmonth("comment_date")
    before = entries.filter(day % WITHDRAWN_DAY[0] == WITHDRAWN_DAY[1])
    corrected = entries.filter(day % CORRECTED_DAY[0] == CORRECTED_DAY[1]).withColumns({
        "comment_date": F.date_add("comment_date", 1), "comment_by": F.lit("corrector")})
    copies = (entries.filter(F.col("comment_seq") == COPIED_SEQ).join(sizes, "incident_id")
              .withColumn("comment_seq", (F.col("comment_seq") + F.col("_n")).cast("int")).drop("_n"))
    return before, corrected.unionByName(copies.select(*entries.columns))


def typed_cases(df: DataFrame, given: dict[str, Column]) -> DataFrame:
    """The 37-column typed case header; columns not given are NULL."""
    return df.select(*[
        (given[n] if n in given else F.lit(None)).cast(spark_type(t)).alias(n) for n, t in CASE_COLUMNS
    ])


def wording(key: str, rules) -> Column:
    return F.concat(*[F.when(F.col(key) % m == r, F.lit(t)).otherwise("") for m, r, t in rules])


def _close_date(last: Column) -> Column:
    expr = None
    for seg, off in CLOSE_OFFSET_BY_SEGMENT:
        hit = F.col("c_mktsegment") == seg
        expr = F.when(hit, F.date_add(last, off)) if expr is None else expr.when(hit, F.date_add(last, off))
    return expr


def _case(category: str, key: str) -> Column:
    return F.concat(F.lit(f"{category}-"), padded(key, 6))


def _customer_cases(per_case: DataFrame, key: str, category: str, customer: DataFrame) -> DataFrame:
    cust = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = per_case.join(cust, per_case[key] == cust["c_custkey"], "left")
    return typed_cases(j, {
        "incident_id": _case(category, key),
        "title": F.col("c_name"),
        "incident_div": F.col("c_mktsegment"),
        "hospital": F.col("c_nationkey"),
        "registered_by": F.col("c_name"),
        "registered_date": F.col("_first"),
        "description": F.concat("c_name", wording(key, CASE_WORDING)),
        "assigned_to": F.when(F.col("c_mktsegment") != "MACHINERY",
                              F.format_string("person%04d", F.col("c_nationkey"))),
        "patch_no": F.when(F.col("c_acctbal") > 5000, F.format_string("P%06d", F.col("c_custkey"))),
        "close_date": _close_date(F.col("_last")),
        "status": F.col("c_mktsegment"),
        "last_updated_date": F.col("_last"),
    })


def event_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Adapter E: a case per user, an entry per event, as of 2024-02-15."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.to_date("ts").alias("_day"))
    ranked = seq_within_case(ev, "user_id", "_day",
                             [F.col("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()],
                             f"{run_id(spark, sf_dir, 'events')}_ranked")
    entries = ranked.select(
        _case("EV", "user_id").alias("incident_id"),
        "comment_seq",
        F.col("event_type").alias("comment_div"),
        F.when(F.col("value").isNotNull(),
               F.format_string("person%04d", F.floor("value").cast("int"))).alias("comment_by"),
        F.col("_day").alias("comment_date"),
        F.concat("props", wording("event_id", EVENT_WORDING)).alias("comment"),
    )
    per_user = ev.groupBy("user_id").agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"),
                                    F.count(F.lit(1)).alias("_n"))
    sizes = per_user.select(_case("EV", "user_id").alias("incident_id"), "_n")
    cases = _customer_cases(per_user, "user_id", "EV", table(spark, sf_dir, "customer"))
    types, aliases, members = masters(spark, EVENT_TYPES, EVENT_ALIASES)
    return Inputs(cases, entries, types, aliases, members, EVENTS_AS_OF, *case_corrections(cases),
                  *entry_corrections(entries, sizes))


def order_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Adapter O: a case per customer, an entry per order, as of 2001-12-31."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.to_date("o_orderdate").alias("_day"))
    state = run_id(spark, sf_dir, "orders")
    ranked = seq_within_case(o, "o_custkey", "_day", [F.col("o_orderkey").asc_nulls_last()], f"{state}_ranked")
    entries = ranked.select(
        _case("CU", "o_custkey").alias("incident_id"),
        "comment_seq",
        F.col("o_orderstatus").alias("comment_div"),
        F.col("o_orderpriority").alias("comment_by"),
        F.col("_day").alias("comment_date"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("comment"),
    )
    # the headers, both sides of their corrections and the sizes read them: orders are grouped once
    per_cust = layer(spark, f"{state}_per_cust", lambda: o.groupBy("o_custkey").agg(
        F.min("_day").alias("_first"), F.max("_day").alias("_last"), F.count(F.lit(1)).alias("_n")))
    sizes = per_cust.select(_case("CU", "o_custkey").alias("incident_id"), "_n")
    cases = _customer_cases(per_cust, "o_custkey", "CU", table(spark, sf_dir, "customer"))
    types, aliases, members = masters(spark, ORDER_TYPES, ORDER_ALIASES)
    return Inputs(cases, entries, types, aliases, members, ORDERS_AS_OF, *case_corrections(cases),
                  *entry_corrections(entries, sizes))


def _slash_date(days: Column) -> Column:
    """``yyyy/M/d`` text of HISTORY_EPOCH + days (unpadded, like the exports)."""
    return F.date_format(F.date_add(F.lit(HISTORY_EPOCH), days.cast("int")), "yyyy/M/d")


def conversation_histories(spark: SparkSession, sf_dir: str, meta_days: Column | None = None,
                           meta_format: str = "yyyy/M/d", reg_days: Column | None = None) -> DataFrame:
    """Adapter T: one history cell per conversation turn.

    Every sentence-ending line (``.`` before a newline) and the end of the text
    get the suffix ``(role:Team)role yyyy/M/d)``, so lines without a final
    period are carried over into the next entry.  Dates are unpadded: short
    ones are cut at ten characters by the splitter, as upstream.
    """
    c = table(spark, sf_dir, "conversations")
    days = F.col("turn") if meta_days is None else meta_days
    meta_date = F.date_format(F.date_add(F.lit(HISTORY_EPOCH), days.cast("int")), meta_format)
    meta = F.concat(F.lit("("), F.col("role"), F.lit(":Team)"), F.col("role"), F.lit(" "),
                    meta_date, F.lit(")"))
    history = F.concat(F.regexp_replace(F.col("text"), F.lit("\\.\n"), F.concat(F.lit("."), meta, F.lit("\n"))),
                       meta)
    return c.select(
        F.format_string("CV-%06d-%04d", F.col("conv_id"), F.col("turn")).alias("incident_id"),
        F.col("role").alias("registered_by"),
        _slash_date(F.col("conv_id") if reg_days is None else reg_days).alias("registered_date"),
        F.format_string("%s turn %d", F.col("role"), F.col("turn")).alias("description"),
        history.alias("comment_history"),
    )


# Conversation warehouse: a case per turn row, registered HISTORY_EPOCH + turn,
# entries from its history dated two days later (zero-padded), as of 2024-02-15.
CONVERSATIONS_AS_OF = _dt.date(2024, 2, 15)
CONVERSATION_TYPES = [
    ("新規登録", "dev", False, False, False, False),
    ("user", "field", False, False, False, True),
    ("assistant", "dev", True, False, False, True),
]
CONVERSATION_ALIASES = [("Team)user", "Team)customer")]


def conversation_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Adapter T as a whole warehouse: history text -> split -> typed."""
    from ..operators.history import split_history
    from ..sources.layout import typed_projection
    from ..sources.schemas import ENTRY_COLUMNS
    from ..functions.dates import try_date
    hist = conversation_histories(spark, sf_dir, meta_days=F.col("turn") + 2, meta_format="yyyy/MM/dd",
                                  reg_days=F.col("turn"))
    entries = typed_projection(split_history(hist), ENTRY_COLUMNS)
    reg = try_date("registered_date")
    cases = typed_cases(hist, {
        "incident_id": F.col("incident_id"),
        "title": F.col("description"),
        "registered_by": F.col("registered_by"),
        "registered_date": reg,
        "description": F.col("description"),
        "assigned_to": F.when(F.col("registered_by") == "user", F.lit("person0003")),
        "close_date": F.when(F.col("registered_by") == "user", F.date_add(reg, 30)),
        "comment_history": F.col("comment_history"),
    })
    types, aliases, members = masters(spark, CONVERSATION_TYPES, CONVERSATION_ALIASES)
    return Inputs(cases, entries, types, aliases, members, CONVERSATIONS_AS_OF)

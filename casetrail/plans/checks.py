"""Registered queries for the single operators (P1, P2, P5/F15, C1, C3, Q1/Q2,
S5, S6), each over a whole driver table, with their DuckDB SQL."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.keys import case_id, entry_id, joined, seq4
from ..operators.history import split_history
from ..operators.overlay import overlay
from ..operators.quality import unique_violations
from ..sources.files import write_export
from ..sources.ids import bad_ids, id_domain
from ..sources.layers import layer, location
from ..sources.layout import column_map, typed_projection
from ..sources.schemas import ENTRY_COLUMNS
from . import adapters as A
from . import oracle as O
from .seeds import build_seeds

# --- P2 typed projection over orders rendered as export text ---------------
ORDER_TEXT_COLUMNS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                      ("o_orderdate", "date"), ("o_orderstatus", "string")]


def typed_projection_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as all-text rows (F: yyyy-M-d, O: the placeholder, P: day + 27,
    often no real date), typed back by P2."""
    o = A.table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    text_date = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-M-d"))
                 .when(F.col("o_orderstatus") == "O", F.lit("yyyy/mm/dd"))
                 .otherwise(F.concat(F.year(d), F.lit("/"), F.month(d), F.lit("/"), F.dayofmonth(d) + 27)))
    raw = o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                   F.col("o_custkey").cast("string").alias("o_custkey"),
                   text_date.alias("o_orderdate"), "o_orderstatus")
    return typed_projection(raw, ORDER_TEXT_COLUMNS)


TYPED_PROJECTION_SQL = f"""WITH raw AS (
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CASE WHEN o_orderstatus = 'F' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%-m-%-d')
       WHEN o_orderstatus = 'O' THEN 'yyyy/mm/dd'
       ELSE CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/'
            || CAST(day(o_orderdate) + 27 AS VARCHAR) END AS o_orderdate,
  o_orderstatus
FROM orders)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey,
  {O.try_date_sql('o_orderdate')} AS o_orderdate, o_orderstatus FROM raw"""

# --- P1 column map -----------------------------------------------------------
ORDER_COLUMN_MAP = [
    {"name": "case_no", "type": "map", "source": "o_orderkey"},
    {"name": "customer", "type": "map", "source": "o_custkey"},
    {"name": "source_system", "type": "const", "value": "orders"},
    {"name": "category2", "type": "blank"},
    {"name": "status", "type": "map", "source": "o_orderstatus"},
    {"name": "priority", "type": "map", "source": "o_orderpriority"},
    {"name": "legacy_field", "type": "retired"},
]


def column_map_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_map(A.table(spark, sf_dir, "orders"), ORDER_COLUMN_MAP)


COLUMN_MAP_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS case_no, CAST(o_custkey AS VARCHAR) AS customer,
  'orders' AS source_system, '' AS category2, o_orderstatus AS status, o_orderpriority AS priority,
  '' AS legacy_field FROM orders"""

# --- P5 / F15 / F16 text flags over whole documents --------------------------


def text_flags_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, to which the fixed wordings are appended by rules on the id."""
    d = A.table(spark, sf_dir, "documents").select("doc_id", F.concat("text", A.wording("doc_id", DOCUMENT_WORDING)).alias("text"))
    return d.select("doc_id",
                    TX.has_library_change("text").alias("has_library_change"),
                    TX.is_force_close_announce("text").alias("is_force_close_announce"),
                    TX.is_force_close("text").alias("is_force_close"))


DOCUMENT_WORDING = A.EVENT_WORDING + A.CASE_WORDING

TEXT_FLAGS_SQL = f"""SELECT doc_id,
  CASE WHEN text LIKE {O.q('%' + TX.LIBRARY_MARK + '%')} AND text LIKE {O.q('%' + TX.LIBRARY_PHRASE + '%')}
       THEN TRUE ELSE FALSE END AS has_library_change,
  coalesce(regexp_matches(text, {O.q(TX.FORCE_CLOSE_ANNOUNCE_PATTERN)}, 's'), FALSE) AS is_force_close_announce,
  coalesce(regexp_matches(text, {O.q(TX.FORCE_CLOSE_PATTERN)}, 's'), FALSE) AS is_force_close
FROM (SELECT doc_id, text || {O._wording_sql('doc_id', DOCUMENT_WORDING)} AS text FROM documents)"""

# --- C3 overlay over orders ----------------------------------------------------


def overlay_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Before = urgent pending orders (removed); after = every urgent order with
    its priority corrected (added, also where the key was not in before)."""
    o = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"),
        "o_orderpriority")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    before = o.filter(urgent & (F.col("o_orderstatus") == "P")).select("o_orderkey")
    after = o.filter(urgent).withColumn("o_orderpriority", F.lit("2-HIGH"))
    return overlay(o, before, after, ["o_orderkey"])


OVERLAY_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders),
before AS (SELECT o_orderkey FROM o WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'),
after AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, '2-HIGH' AS o_orderpriority
          FROM o WHERE o_orderpriority = '1-URGENT')
SELECT * FROM o t1 WHERE NOT EXISTS (SELECT 1 FROM before t2 WHERE t2.o_orderkey = t1.o_orderkey)
UNION ALL SELECT * FROM after"""

# --- C1 / C2 history splitter over conversations ------------------------------


def split_history_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_history(A.conversation_histories(spark, sf_dir))


def split_history_typed_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splitter output typed by P2 (short dates cut at ten characters -> NULL)."""
    return typed_projection(split_history_conversations(spark, sf_dir), ENTRY_COLUMNS)


# --- S1-S4, C14: export batches -> seed tables over conversations ---------------
# The export's columns; its texts are those of the histories with other than ASCII
# characters replaced, behind vendor characters that only cp932 as Windows has it can write.
EXPORT_COLUMNS = {"管理NO": "incident_id", "登録者": "registered_by", "登録日": "registered_date", "内容": "description",
                  "履歴": "comment_history"}
EXPORT_BATCHES, NOT_ASCII, VENDOR_MARK = 4, "[^\\x00-\\x7F]", "①髙"
SEED_MAP = ([{"name": c, "type": "map", "source": e} for e, c in EXPORT_COLUMNS.items()]
            + [{"name": "status", "type": "const", "value": "取込"}, {"name": "patch_no", "type": "blank"}])


def _seeds(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Conversations written as export batches, read, relaid and landed; the landed table is kept."""
    key = A.run_id(spark, sf_dir, "conversations")

    def chain() -> DataFrame:
        folder = f"{location(spark)}/{key}_{which}_{uuid.uuid4().hex[:8]}"
        hist = A.conversation_histories(spark, sf_dir).withColumn("description", F.concat(F.lit(VENDOR_MARK), "description"))
        hist = hist.withColumn("comment_history", F.regexp_replace("comment_history", NOT_ASCII, "?"))
        write_export(hist.select(*[F.col(c).alias(e) for e, c in EXPORT_COLUMNS.items()]), f"{folder}/export", EXPORT_BATCHES)
        cases, entries = build_seeds(spark, f"{folder}/export", SEED_MAP, f"{folder}/cases", f"{folder}/entries")
        return cases if which == "seed_cases" else entries
    return layer(spark, f"{key}_{which}", chain)


def seed_cases_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seeds(spark, sf_dir, "seed_cases")


def seed_entries_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seeds(spark, sf_dir, "seed_entries")


_EXPORTED = O.history_ctes(text=f"regexp_replace(text, {O.q(NOT_ASCII)}, '?', 'g')",
                           description=f"{O.q(VENDOR_MARK)} || printf('%s turn %d', role, turn)")
_LINE_END = "chr(13) || chr(10) || '?'"
SEED_CASES_SQL = O.with_query(_EXPORTED, f"""SELECT incident_id, registered_by, registered_date, description,
  regexp_replace(comment_history, {_LINE_END}, chr(10), 'g') AS comment_history, '取込' AS status,
  CAST(NULL AS VARCHAR) AS patch_no FROM hist""")
SEED_ENTRIES_SQL = O.with_query(_EXPORTED, "SELECT * FROM split")

# --- Q1 / Q2 uniqueness -----------------------------------------------------------


def unique_line_ids_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on an expression key: order key || '_' || line number (repeats exist)."""
    li = A.table(spark, sf_dir, "lineitem")
    return unique_violations(li, [joined(F.col("l_orderkey").cast("string"), seq4("l_linenumber"))], ["line_id"])


UNIQUE_LINE_IDS_SQL = """SELECT line_id, count(*) AS n_rows FROM (
  SELECT CAST(l_orderkey AS VARCHAR) || '_' || printf('%04d', l_linenumber) AS line_id FROM lineitem)
WHERE line_id IS NOT NULL GROUP BY line_id HAVING count(*) > 1"""


def unique_order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on a single column (passes: no rows)."""
    return unique_violations(A.table(spark, sf_dir, "orders"), ["o_orderkey"])


UNIQUE_ORDER_KEYS_SQL = """SELECT o_orderkey, count(*) AS n_rows FROM orders WHERE o_orderkey IS NOT NULL
GROUP BY o_orderkey HAVING count(*) > 1"""


def unique_entry_ids_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 on the staged entry id of the events warehouse (passes: no rows)."""
    from .warehouse import staged
    _, entries = staged(A.event_inputs(spark, sf_dir))
    return unique_violations(entries, [entry_id("incident_id", "comment_seq")], ["comment_id"])


UNIQUE_ENTRY_IDS_SQL = O.with_query(
    O.event_ctes() + O.warehouse_ctes(A.EVENTS_AS_OF),
    """SELECT comment_id, count(*) AS n_rows FROM (
  SELECT incident_id || '_' || printf('%04d', comment_seq) AS comment_id FROM stg_entries)
WHERE comment_id IS NOT NULL GROUP BY comment_id HAVING count(*) > 1""")

# --- S5 id domain, S6 id format -----------------------------------------------------


def case_id_domain_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids ORD-000001 .. ORD-<highest order key>, flagged when issued."""
    o = A.table(spark, sf_dir, "orders")
    top = o.agg(F.max("o_orderkey")).first()[0] or 0
    issued = o.select(case_id("ORD", F.col("o_orderkey")).alias("_issued"))
    dom = id_domain(spark, "ORD", top)
    j = dom.join(issued, dom["incident_id"] == issued["_issued"], "left")
    return j.select("incident_id", F.col("_issued").isNotNull().alias("is_issued"))


CASE_ID_DOMAIN_SQL = """SELECT printf('ORD-%06d', r.i) AS incident_id, (o.o_orderkey IS NOT NULL) AS is_issued
FROM range(1, (SELECT coalesce(max(o_orderkey), 0) FROM orders) + 1) AS r(i)
LEFT JOIN orders o ON o.o_orderkey = r.i"""


def bad_case_ids_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids '<status>-<order key>' checked against category F (O and P fail)."""
    o = A.table(spark, sf_dir, "orders").select(
        F.concat(F.col("o_orderstatus"), F.lit("-"), F.format_string("%06d", F.col("o_orderkey"))).alias("case_no"),
        "o_orderkey")
    return bad_ids(o, "case_no", "F")


BAD_CASE_IDS_SQL = """SELECT case_no, o_orderkey FROM (
  SELECT o_orderstatus || '-' || printf('%06d', o_orderkey) AS case_no, o_orderkey FROM orders)
WHERE NOT coalesce(regexp_matches(case_no, '^F-[0-9]{6}'), FALSE)"""


CHECKS = {
    "typed_projection_orders": (typed_projection_orders, TYPED_PROJECTION_SQL),
    "column_map_orders": (column_map_orders, COLUMN_MAP_SQL),
    "text_flags_documents": (text_flags_documents, TEXT_FLAGS_SQL),
    "overlay_orders": (overlay_orders, OVERLAY_SQL),
    "split_history_conversations": (split_history_conversations, O.split_history_sql()),
    "split_history_typed_conversations": (split_history_typed_conversations, O.split_history_typed_sql()),
    "seed_cases_conversations": (seed_cases_conversations, SEED_CASES_SQL),
    "seed_entries_conversations": (seed_entries_conversations, SEED_ENTRIES_SQL),
    "unique_line_ids_lineitem": (unique_line_ids_lineitem, UNIQUE_LINE_IDS_SQL),
    "unique_order_keys": (unique_order_keys, UNIQUE_ORDER_KEYS_SQL),
    "unique_entry_ids_events": (unique_entry_ids_events, UNIQUE_ENTRY_IDS_SQL),
    "case_id_domain_orders": (case_id_domain_orders, CASE_ID_DOMAIN_SQL),
    "bad_case_ids_orders": (bad_case_ids_orders, BAD_CASE_IDS_SQL),
}

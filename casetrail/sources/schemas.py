"""Declared schemas: cases, entries and the small masters.

Columns are kept as ordered ``(name, type)`` lists so the typed projection,
the empty overlays and the test fixtures are all driven by the same list.
"""
from __future__ import annotations

from pyspark.sql import types as T

# Case header: 37 columns in file order; dates arrive as text and are typed by P2.
CASE_COLUMNS: list[tuple[str, str]] = [
    ("incident_id", "string"),
    ("title", "string"),
    ("incident_div", "string"),
    ("category", "string"),
    ("category2", "string"),
    ("category3", "string"),
    ("hospital", "string"),
    ("registered_by", "string"),
    ("registered_date", "date"),
    ("impact", "string"),
    ("impact_by_register", "string"),
    ("related_incident", "string"),
    ("description", "string"),
    ("assigned_to", "string"),
    ("solution_div", "string"),
    ("latest_comment_by", "string"),
    ("latest_comment_date", "date"),
    ("first_response_date", "date"),
    ("patch_no", "string"),
    ("close_date", "date"),
    ("status", "string"),
    ("server", "string"),
    ("version", "string"),
    ("version_ehr", "string"),
    ("comment_div", "string"),
    ("last_updated_date", "date"),
    ("approved_date", "date"),
    ("delivery_planned_date", "date"),
    ("comment_history", "string"),
    ("critical", "string"),
    ("event", "string"),
    ("event_date", "date"),
    ("external_case_id", "string"),
    ("additional_item1", "string"),
    ("additional_item2", "string"),
    ("additional_item3", "string"),
    ("additional_item4", "string"),
]
CASE_KEYS = ["incident_id"]

# Entry log: composite key (incident_id, comment_seq); seq 0 is the registration.
ENTRY_COLUMNS: list[tuple[str, str]] = [
    ("incident_id", "string"),
    ("comment_seq", "int"),
    ("comment_div", "string"),
    ("comment_by", "string"),
    ("comment_date", "date"),
    ("comment", "string"),
]
ENTRY_KEYS = ["incident_id", "comment_seq"]

_SPARK_TYPES = {
    "string": T.StringType(),
    "text": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
}


def spark_type(name: str) -> T.DataType:
    return _SPARK_TYPES[name]


def struct_of(columns: list[tuple[str, str]], all_text: bool = False) -> T.StructType:
    """StructType from a column list; ``all_text`` gives the raw all-string form."""
    return T.StructType([
        T.StructField(n, T.StringType() if all_text else spark_type(t), True) for n, t in columns
    ])


CASES_RAW = struct_of(CASE_COLUMNS, all_text=True)
CASES_TYPED = struct_of(CASE_COLUMNS)
ENTRIES_RAW = T.StructType([
    T.StructField("incident_id", T.StringType()),
    T.StructField("comment_seq", T.IntegerType()),
    T.StructField("comment_div", T.StringType()),
    T.StructField("comment_by", T.StringType()),
    T.StructField("comment_date", T.StringType()),
    T.StructField("comment", T.StringType()),
])
ENTRIES_TYPED = struct_of(ENTRY_COLUMNS)

# Entry-type master: type -> owner side and four flags.  The flags are read as
# text because seed files hold 0/1, then cast.
ENTRY_TYPES = T.StructType([
    T.StructField("comment_div", T.StringType()),
    T.StructField("ball_on", T.StringType()),
    T.StructField("is_closer", T.BooleanType()),
    T.StructField("is_approver", T.BooleanType()),
    T.StructField("is_patch_planned", T.BooleanType()),
    T.StructField("is_response", T.BooleanType()),
])
ENTRY_TYPES_RAW = T.StructType([T.StructField(f.name, T.StringType()) for f in ENTRY_TYPES.fields])
MEMBERS = T.StructType([T.StructField("user_name", T.StringType())])
ALIASES = T.StructType([
    T.StructField("user_name", T.StringType()),
    T.StructField("user_name_adjusted", T.StringType()),
])

# Seed builder: history splitter input / output.
HISTORY_INPUT = T.StructType([
    T.StructField("incident_id", T.StringType()),
    T.StructField("registered_by", T.StringType()),
    T.StructField("registered_date", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("comment_history", T.StringType()),
])

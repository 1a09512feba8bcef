"""Literal-row builders for the model's tables."""
import datetime as dt

from casetrail.sources.schemas import ALIASES, CASE_COLUMNS, CASES_TYPED, ENTRIES_TYPED, ENTRY_TYPES, MEMBERS


def D(s):
    return None if s is None else dt.date.fromisoformat(s)


def cases_df(spark, rows):
    """rows: list of dicts with any case columns; the rest are NULL."""
    names = [n for n, _ in CASE_COLUMNS]
    out = []
    for r in rows:
        vals = []
        for n, t in CASE_COLUMNS:
            v = r.get(n)
            if t == "date" and isinstance(v, str):
                v = D(v)
            vals.append(v)
        out.append(tuple(vals))
    return spark.createDataFrame(out, CASES_TYPED).select(*names)


def entries_df(spark, rows):
    """rows: (incident_id, seq, type, by, date, text)."""
    return spark.createDataFrame([(a, b, c, d, D(e), f) for a, b, c, d, e, f in rows], ENTRIES_TYPED)


def types_df(spark, rows):
    return spark.createDataFrame(rows, ENTRY_TYPES)


def aliases_df(spark, rows):
    return spark.createDataFrame(rows, ALIASES)


def members_df(spark, names):
    return spark.createDataFrame([(n,) for n in names], MEMBERS)


# A small type master: register (dev), answer (field, response), request (dev),
# close (field, closer, response), approve (dev, approver), patch (dev, patch planned, response).
TYPES = [
    ("register", "dev", False, False, False, False),
    ("answer", "field", False, False, False, True),
    ("request", "dev", False, False, False, False),
    ("close", "field", True, False, False, True),
    ("approve", "dev", False, True, False, False),
    ("patch", "dev", False, False, True, True),
    ("direct", "filed", True, False, False, True),
]

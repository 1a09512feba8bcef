"""Shared helpers for the operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest side (rows) we are willing to broadcast to every executor.  Masters
# are a few hundred rows; anything above this goes through a shuffle join.
BROADCAST_MAX_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` is proven to hold at most ``max_rows`` rows.  The check reads
    at most ``max_rows + 1`` of them, once: the verdict stays with the frame."""
    if getattr(df, "_casetrail_checked", None) is None:
        df._casetrail_checked = df.limit(max_rows + 1).count() <= max_rows
    return df._casetrail_checked


def small_side(df: DataFrame, *columns: Column, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``df`` (or ``columns`` of it) with a broadcast hint, only where it is proven
    small; otherwise unhinted, and Spark plans a shuffle (sort-merge) join."""
    small = is_small(df, max_rows)
    out = df.select(*columns) if columns else df
    out = F.broadcast(out) if small else out
    out._casetrail_checked = small
    return out


def known_small(df: DataFrame, n_rows: int, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Like :func:`small_side` for a frame whose row count is already known
    (e.g. built from a local list): no counting job is needed."""
    out = F.broadcast(df) if n_rows <= max_rows else df
    out._casetrail_checked = n_rows <= max_rows
    return out


def coded(df: DataFrame, keys: list[str]) -> DataFrame | None:
    """The distinct ``keys`` of a master proven small, numbered (``_code``), for
    picks that carry a number instead of texts; None where it isn't small."""
    if not is_small(df):
        return None
    known = getattr(df, "_casetrail_codes", None)
    if known is None:
        part = df.select(*keys).distinct()
        rows = sorted(part.collect(), key=lambda r: [(v is not None, v) for v in r])
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in part.schema) + ", _code int"
        known = df._casetrail_codes = known_small(
            df.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema), len(rows))
    return known

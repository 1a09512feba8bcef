"""Registered queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL | None).

Every query reads the driver's tables (or what Spark derives from them) in
full; the masters are the adapters' small fixed setup.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters as A
from . import oracle as O
from .warehouse import build, staged
from ..functions.text import DIRECT_CLOSE_TYPE

QueryFn = Callable[[SparkSession, str], DataFrame]

_INPUTS = {"events": A.event_inputs, "orders": A.order_inputs, "conversations": A.conversation_inputs}


def _layer(adapter: str, layer: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inp = _INPUTS[adapter](spark, sf_dir)
        if layer in ("stg_cases", "stg_entries", "direct_close"):
            cases, entries = staged(inp)
            if layer == "direct_close":
                return entries.filter(F.col("comment_div") == DIRECT_CLOSE_TYPE)
            return cases if layer == "stg_cases" else entries
        # stored: layers that this query's plan reads more than once, or that others share
        tables = {"calendar": (), "dim_calendar": (), "lifecycle": ("stg_entries",)}.get(layer, ("stg_entries", "lifecycle"))
        wh = build(inp, tables=tables, run_id=A.run_id(spark, sf_dir, adapter))
        return getattr(wh, layer)  # only this layer (and what it needs) is planned
    run.__name__ = f"{layer}_{adapter}"
    return run


# (query name, adapter, warehouse layer)
_WAREHOUSE_QUERIES = [
    ("stage_cases_events", "events", "stg_cases"),
    ("stage_entries_events", "events", "stg_entries"),
    ("direct_close_events", "events", "direct_close"),
    ("entry_lifecycle_events", "events", "lifecycle"),
    ("case_rollup_events", "events", "rollup"),
    ("active_cases_events", "events", "active"),
    ("fiscal_calendar_events", "events", "calendar"),
    ("daily_counts_events", "events", "daily"),
    ("monthly_counts_events", "events", "monthly"),
    ("mart_monthly_events", "events", "mart_monthly"),
    ("stage_cases_orders", "orders", "stg_cases"),
    ("stage_entries_orders", "orders", "stg_entries"),
    ("entry_lifecycle_orders", "orders", "lifecycle"),
    ("case_rollup_orders", "orders", "rollup"),
    ("active_cases_orders", "orders", "active"),
    ("fiscal_calendar_orders", "orders", "calendar"),
    ("dim_calendar_orders", "orders", "dim_calendar"),
    ("daily_counts_orders", "orders", "daily"),
    ("monthly_counts_orders", "orders", "monthly"),
    ("mart_monthly_orders", "orders", "mart_monthly"),
    ("stage_entries_conversations", "conversations", "stg_entries"),
    ("entry_lifecycle_conversations", "conversations", "lifecycle"),
    ("case_rollup_conversations", "conversations", "rollup"),
    ("daily_counts_conversations", "conversations", "daily"),
    ("monthly_counts_conversations", "conversations", "monthly"),
]


def registry() -> dict[str, tuple[QueryFn, str | None]]:
    out: dict[str, tuple[QueryFn, str | None]] = {}
    for name, adapter, layer in _WAREHOUSE_QUERIES:
        out[name] = (_layer(adapter, layer), O.warehouse_sql(adapter, layer))
    from .checks import CHECKS
    out.update(CHECKS)
    return out

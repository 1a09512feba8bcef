"""The whole warehouse build as one lazy DataFrame graph.

Layer order: staging (cases, entries) -> lifecycle -> rollup, calendar ->
daily -> monthly -> marts.  The layers named in ``tables`` are stored as tables
of the catalog (``sources.layers``), which cuts lineage: a lost executor only
recomputes from the last stored layer.  Staged entries and the lifecycle are
bucketed by (case, segment), so that the layers above share that one shuffle.
"""
from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators.calendar import fiscal_calendar
from ..operators.lifecycle import LIFECYCLE_COLUMNS, entry_lifecycle, with_segments
from ..operators.marts import MART_SCOPE_YEARS, active_cases, dim_calendar, dim_entry_type, mart_monthly, scope_start
from ..operators.monthly import monthly_from_intervals, monthly_stretches
from ..operators.rollup import case_rollup
from ..operators.spine import daily_counts
from ..operators.staging import STAGED_ENTRY_COLUMNS, stage_cases, stage_entries
from ..operators.common import small_side
from ..sources.layers import drop_layers, layer
from ..sources.schemas import CASES_TYPED, ENTRIES_TYPED


@dataclass
class Inputs:
    """Typed base tables and masters of one warehouse."""
    cases: DataFrame
    entries: DataFrame
    types: DataFrame
    aliases: DataFrame
    members: DataFrame
    as_of: _dt.date
    cases_before: DataFrame | None = None
    cases_after: DataFrame | None = None
    entries_before: DataFrame | None = None
    entries_after: DataFrame | None = None
    _checked: bool = False

    def overlays(self):
        """(cases_before, cases_after, entries_before, entries_after); a missing
        pair means no corrections, and the overlay is then the identity."""
        spark = self.cases.sparkSession

        def pair(before, after, schema):
            if before is None and after is None:
                return None, None
            empty = spark.createDataFrame([], schema)
            return (before if before is not None else empty,
                    after if after is not None else empty)
        return pair(self.cases_before, self.cases_after, CASES_TYPED) + \
            pair(self.entries_before, self.entries_after, ENTRIES_TYPED)

    def checked(self) -> "Inputs":
        """Size-check the masters once (broadcast only if proven small)."""
        if not self._checked:
            self.types, self.aliases, self.members = map(small_side, (self.types, self.aliases, self.members))
            self._checked = True
        return self


#: What entries and the lifecycle are bucketed by when stored.
SEGMENT_KEYS = ["incident_id", "_seg"]


class Warehouse:
    """All layers of one build; each is planned on first access only, and the
    layers named in ``tables`` are stored when first reached.  A build with the
    ``run_id`` of an earlier one of the same application finds its tables."""

    def __init__(self, inp: Inputs, scope_years: int, tables: tuple[str, ...], run_id: str):
        self.inp, self.scope_years, self.tables, self.run_id = inp, scope_years, tables, run_id

    def drop_tables(self) -> None:
        """Drop this build's stored layers (call when the results are consumed)."""
        drop_layers(self.inp.cases.sparkSession, f"{self.run_id}_")

    def _keep(self, name: str, make, buckets=(), laid_out: bool = False) -> DataFrame:
        if name not in self.tables:
            return make()
        return layer(self.inp.cases.sparkSession, f"{self.run_id}_{name}", make, buckets, laid_out)

    @cached_property
    def cases(self) -> DataFrame:
        cb, ca, _, _ = self.inp.checked().overlays()
        return self._keep("stg_cases", lambda: stage_cases(self.inp.cases, cb, ca))

    @cached_property
    def entries_x(self) -> DataFrame:
        """Staged entries with the segment that they lie in.

        Stored ones are read by the sizes of the segments and by the write, and the
        overlay by the direct close too: it is made once, stored until they are."""
        _, _, eb, ea = self.inp.checked().overlays()
        spark, stored, made = self.inp.cases.sparkSession, "stg_entries" in self.tables, []

        def keep(name, df):
            if not stored:
                return df
            made.append(f"{self.run_id}_{name}")
            return layer(spark, made[-1], lambda: df)

        def make():
            return with_segments(stage_entries(self.inp.entries, eb, ea, self.cases, self.inp.types, keep))
        out = self._keep("stg_entries", make, SEGMENT_KEYS)
        for name in made:
            drop_layers(spark, name)
        return out

    @property
    def entries(self) -> DataFrame:
        return self.entries_x.select(*STAGED_ENTRY_COLUMNS)

    def _lifecycle(self) -> DataFrame:
        return entry_lifecycle(self.entries_x, self.inp.types, self.inp.aliases, parts=True)

    @cached_property
    def lifecycle_x(self) -> DataFrame:
        """The lifecycle with ``PART_COLUMNS`` and without the texts, which no later layer reads."""
        return self._keep("lifecycle", lambda: self._lifecycle().drop("comment"), SEGMENT_KEYS,
                          laid_out="stg_entries" in self.tables)

    @cached_property
    def lifecycle(self) -> DataFrame:
        return self._lifecycle().select(*LIFECYCLE_COLUMNS)

    @cached_property
    def rollup(self) -> DataFrame:
        return self._keep("rollup", lambda: case_rollup(self.cases, self.lifecycle_x, self.inp.aliases, self.inp.members,
                                                        self.inp.types))

    @cached_property
    def calendar(self) -> DataFrame:
        return self._keep("calendar", lambda: fiscal_calendar(self.cases, self.inp.as_of))

    @cached_property
    def daily(self) -> DataFrame:
        return self._keep("daily", lambda: daily_counts(self.lifecycle_x, self.calendar, self.inp.as_of))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._keep("monthly", lambda: monthly_from_intervals(self.lifecycle_x, self.calendar, self.inp.as_of))

    @cached_property
    def active(self) -> DataFrame:
        return active_cases(self.rollup)

    @cached_property
    def mart_monthly(self) -> DataFrame:
        if "monthly" in self.tables:
            monthly = self.monthly
        else:  # no month before the mart's scope is made
            monthly = monthly_stretches(self.lifecycle_x, self.calendar, self.inp.as_of,
                                        scope_start(self.inp.as_of, self.scope_years))
        return mart_monthly(monthly, self.rollup, self.inp.as_of, self.scope_years)

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return dim_calendar(self.calendar)

    @cached_property
    def dim_entry_type(self) -> DataFrame:
        return dim_entry_type(self.inp.types)


def staged(inp: Inputs) -> tuple[DataFrame, DataFrame]:
    inp.checked()
    cb, ca, eb, ea = inp.overlays()
    cases = stage_cases(inp.cases, cb, ca)
    entries = stage_entries(inp.entries, eb, ea, cases, inp.types)
    return cases, entries


# Layers read more than once downstream; stored as tables by default.
SHARED_LAYERS = ("stg_entries",)
ALL_TABLE_LAYERS = ("stg_cases", "stg_entries", "lifecycle", "rollup", "calendar", "daily", "monthly")


def build(inp: Inputs, scope_years: int = MART_SCOPE_YEARS, tables: tuple[str, ...] = SHARED_LAYERS,
          run_id: str | None = None) -> Warehouse:
    """The warehouse over ``inp``; layers are planned lazily, and those named in
    ``tables`` are stored as tables when first reached (use ``ALL_TABLE_LAYERS``
    for a full stored build)."""
    return Warehouse(inp, scope_years, tuple(tables), run_id or f"run_{uuid.uuid4().hex[:12]}")

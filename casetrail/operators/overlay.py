"""Correction overlay (before / after images)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def overlay(base: DataFrame, before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``base`` whose key is not in ``before``, plus every row of ``after``.

    Not a merge: an ``after`` row is added even when its key is absent from
    ``before``.  A NULL key never matches, so such base rows are kept.
    Columns must be the same set on all three sides (matched by name).
    """
    keys = list(keys)
    if set(base.columns) != set(after.columns):
        raise ValueError("overlay: base and after differ in columns")
    kept = base.join(before.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(after.select(*base.columns))

"""Q1 / Q2: uniqueness checks on a column or an expression."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_violations(df: DataFrame, keys: Sequence[str | Column], names: Sequence[str] | None = None) -> DataFrame:
    """Key values held by more than one row (NULL keys ignored); empty = pass.

    ``keys`` are column names or expressions (e.g. ``entry_id(...)`` for Q2);
    output columns are the keys (named by ``names``) and ``n_rows``.  Counting
    is a partial + final aggregate, so a hot key is combined map-side.
    """
    cols = []
    for i, k in enumerate(keys):
        col = F.col(k) if isinstance(k, str) else k
        name = names[i] if names else (k if isinstance(k, str) else f"key{i + 1}")
        cols.append(col.alias(name))
    t = df.select(*cols)
    for c in t.columns:
        t = t.filter(F.col(c).isNotNull())
    return (t.groupBy(*t.columns).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str | Column]) -> None:
    """Raise when any key value repeats."""
    bad = unique_violations(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"uniqueness violated: {bad[0].asDict()}")

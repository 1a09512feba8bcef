"""S5 id domain and S6 id format check."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import case_id


def id_domain(spark: SparkSession, category: str, max_number: int, column: str = "incident_id") -> DataFrame:
    """``CAT-000001 .. CAT-<max>``; generated in parallel by ``range``."""
    return spark.range(1, int(max_number) + 1).select(case_id(category, F.col("id")).alias(column))


def id_format_ok(ids, category: str) -> Column:
    """S6 predicate: starts with ``CAT-`` and six digits (a tail is accepted)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.coalesce(c.rlike("^" + category + "-[0-9]{6}"), F.lit(False))


def bad_ids(df: DataFrame, column: str, category: str) -> DataFrame:
    """The rows whose id fails the format (empty when the batch is fine)."""
    return df.filter(~id_format_ok(column, category))


def check_ids(df: DataFrame, column: str, category: str) -> None:
    """Raise when any id fails the format (one bad id fails the batch)."""
    bad = bad_ids(df, column, category).select(column).limit(1).collect()
    if bad:
        raise ValueError(f"Invalid id: {bad[0][0]}")

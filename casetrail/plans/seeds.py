"""C14 build_seeds: export CSV -> case table (column map) + entry table (history split).

One Spark job per output; the export is read once per job (multi-line CSV is
read per file), relaid by the column map and written with a refusing writer.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import split_history
from ..sources.files import read_export, read_seed, write_table
from ..sources.layout import column_map


def seed_tables(spark: SparkSession, export_paths: str | Sequence[str],
                mapping: Sequence[Mapping]) -> tuple[DataFrame, DataFrame]:
    """(cases, entries) as lazy frames: P1 over the export, then C1 over the cases."""
    cases = column_map(read_export(spark, export_paths), mapping)
    return cases, split_history(cases)


def build_seeds(spark: SparkSession, export_paths: str | Sequence[str], mapping: Sequence[Mapping],
                cases_out: str, entries_out: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Write both seed tables (an existing target is refused) and return them read back."""
    cases = column_map(read_export(spark, export_paths), mapping)
    # a blank cell is NULL once landed, in either format
    cases = cases.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in cases.columns])

    def land(df: DataFrame, path: str) -> DataFrame:
        write_table(df, path, fmt)
        return read_seed(spark, path, df.schema) if fmt == "csv" else spark.read.parquet(path)
    landed = land(cases, cases_out)
    # entries come from the landed cases: the export is parsed only once
    return landed, land(split_history(landed), entries_out)

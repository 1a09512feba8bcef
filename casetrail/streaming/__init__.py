"""Incremental landing of export batches.

The upstream warehouse is batch only: lifecycle flags need a case's whole
entry log, so every model is a full rebuild over the stored tables.  What does
arrive over time are export batches (S1/S2).  ``land_exports`` picks up new
export files with Structured Streaming's file source and appends them as
Parquet, exactly once (the checkpoint sits in the shared folder), so the batch
build always reads splittable Parquet instead of multi-line CSV.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import EXPORT_ENCODING, _newline_normalised, shared_dir


def export_schema(header: Sequence[str]) -> T.StructType:
    """All-text schema of an export (streams need the schema up front)."""
    return T.StructType([T.StructField(h, T.StringType(), True) for h in header])


def land_exports(spark: SparkSession, source_dir: str, target_dir: str, header: Sequence[str],
                 checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Append every not-yet-seen export file under ``source_dir`` to ``target_dir``.

    ``once=True`` processes what is there and stops (``availableNow``);
    otherwise it keeps watching.  Files are tracked in the checkpoint, so a
    restart after a lost driver or executor neither skips nor repeats a batch.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    ckpt = checkpoint or f"{shared_dir(spark).rstrip('/')}/streams/land_exports"
    stream = (spark.readStream.schema(export_schema(header))
              .option("header", True).option("multiLine", True).option("escape", '"')
              .option("encoding", EXPORT_ENCODING)
              .csv(source_dir))
    w = (_newline_normalised(stream).writeStream.format("parquet")
         .option("path", target_dir).option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()

"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import shared_dir

#: The characters that separate words: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker at once, and how the session says it.
BATCH_BYTES, ARROW_BYTES = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, under the shared folder of the session."""
    return f"{shared_dir(spark).rstrip('/')}/casetrail-llm/{name}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again, so that a
    lost executor costs no more than the tasks after it.  The shuffle files of
    the write go with it, and workers get small batches (the settings hold for this write only)."""
    conf, own = df.sparkSession.conf, {CLEANUP: "true", ARROW_BYTES: str(BATCH_BYTES)}
    before = {k: conf.get(k, "false" if k == CLEANUP else None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete what one run stored (its own folder only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def small_batches(batches: Iterable[pa.RecordBatch], max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` at most (one
    row at least): memory follows the longest text, not the batch size."""
    for b in batches:
        if b.num_rows == 0:
            continue
        rows = max(1, int(b.num_rows * max_bytes / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)

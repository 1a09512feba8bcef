"""Export CSV, seed CSV, refusing writer, layer materialisation."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Encoding of the export files (Windows code page 932).  Java names it
# windows-31j; "Shift_JIS" would garble vendor characters.
EXPORT_ENCODING = "windows-31j"


def _newline_normalised(df: DataFrame) -> DataFrame:
    """Universal newlines inside fields: \\r\\n and lone \\r become \\n."""
    return df.select(*[
        F.regexp_replace(F.col(f"`{f.name}`"), "\r\n?", "\n").alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def read_export(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read one or more export batches (cp932, header, quoted multi-line).

    Each file's header is consumed, so batches concatenate into one frame.
    Multi-line CSV is not splittable: parallelism is one task per file, so land
    the result as Parquet once (:func:`casetrail.plans.seeds.build_seeds`).
    The session option that allows the encoding has to hold when the frame is
    executed, so it stays set.
    """
    if isinstance(paths, str):
        paths = [paths]
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    df = (spark.read
          .option("header", True)
          .option("multiLine", True)
          .option("escape", '"')
          .option("encoding", EXPORT_ENCODING)
          .option("mode", "PERMISSIVE")
          .csv(list(paths)))
    return _newline_normalised(df)


def write_export(df: DataFrame, path: str, batches: int) -> None:
    """Write ``df`` as that many export batches: cp932, a header each, every field
    quoted, line ends inside fields as ``\\r\\n`` (what ``read_export`` reads)."""
    df.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    (df.select(*[F.regexp_replace(F.col(f"`{c}`"), "\r\n?|\n", "\r\n").alias(c) for c in df.columns])
     .repartition(batches).write.mode("errorifexists").option("header", True).option("quoteAll", True)
     .option("escape", '"').option("encoding", EXPORT_ENCODING).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_seed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """S3: UTF-8 (BOM allowed) seed CSV with a declared schema; empty -> NULL.

    Boolean columns are read as text and cast, because seed files hold 0/1.
    """
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType, True)
        for f in schema.fields
    ])
    df = (spark.read.schema(text_schema)
          .option("header", True)
          .option("multiLine", True)
          .option("escape", '"')
          .option("encoding", "UTF-8")
          .csv(path))
    return df.select(*[
        F.col(f.name).cast("boolean").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
        for f in schema.fields
    ])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write, refusing an existing target (``errorifexists``)."""
    w = df.write.mode("errorifexists")
    if fmt == "csv":
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Set by the deployment; tests set their own when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return d


def materialize(df: DataFrame, name: str, kind: str = "view", buckets: Sequence[str] = ()) -> DataFrame:
    """Store a layer as a table of the catalog (read back) or name it as a view.

    A table cuts lineage: later layers read files, so a lost executor only
    recomputes from the last stored layer.  An existing table is refused.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError(f"unknown materialization {kind!r}")
    from .layers import save_layer
    return save_layer(df, name, buckets)

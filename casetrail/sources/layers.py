"""Stored layers as managed tables of the session's catalog.

The tables of one application live in one database whose location is in the
shared folder.  A table is in the catalog only when it is complete, so a
failed build leaves nothing that could be read by mistake; an existing table is
refused, never overwritten; ``release`` drops the database with all its files.
Layers can be bucketed: whoever groups or joins by the bucket columns reads them
without an exchange.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .files import shared_dir


def database(spark: SparkSession) -> str:
    """The application's database, created in the shared folder when first asked for."""
    name = "casetrail_" + re.sub("[^a-z0-9_]", "_", spark.sparkContext.applicationId.lower())
    if not spark.catalog.databaseExists(name):
        place = f"{shared_dir(spark).rstrip('/')}/{name}"  # an error where no shared folder is set
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{place}'")
    return name


def location(spark: SparkSession) -> str:
    """The database's folder; files beside its tables live as long as it."""
    return spark.catalog.getDatabase(database(spark)).locationUri


def save_layer(df: DataFrame, name: str, buckets: Sequence[str] = (), laid_out: bool = False) -> DataFrame:
    """Store ``df`` as table ``name`` (an existing one is an error) and read it back.
    With ``buckets``, rows are dealt to as many buckets as the session has
    shuffle partitions, one file each; ``laid_out`` says that they lie so already."""
    spark = df.sparkSession
    full = f"{database(spark)}.{name}"
    if buckets:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = (df if laid_out else df.repartition(n, *buckets)).write.bucketBy(n, *buckets)
    else:
        writer = df.write
    writer.mode("errorifexists").format("parquet").saveAsTable(full)
    return spark.table(full)


def layer(spark: SparkSession, name: str, make: Callable[[], DataFrame], buckets: Sequence[str] = (),
          laid_out: bool = False) -> DataFrame:
    """Table ``name`` if it is stored already, else what ``make`` gives, stored."""
    full = f"{database(spark)}.{name}"
    return spark.table(full) if spark.catalog.tableExists(full) else save_layer(make(), name, buckets, laid_out)


def drop_layers(spark: SparkSession, prefix: str = "") -> None:
    """Drop the stored tables whose names begin with ``prefix``, with their files."""
    db = database(spark)
    for t in spark.catalog.listTables(db):
        if not t.isTemporary and t.name.startswith(prefix.lower()):
            spark.sql(f"DROP TABLE IF EXISTS {db}.{t.name}")


def release(spark: SparkSession) -> None:
    """Drop the application's database: no stored layer stays in the shared folder."""
    spark.sql(f"DROP DATABASE IF EXISTS {database(spark)} CASCADE")


def snapshot(spark: SparkSession, *paths: str) -> str:
    """A key that changes with the files under ``paths`` (names, sizes, times)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for path in paths:
        root = jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(conf).listFiles(root, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join([*paths, *sorted(seen)]).encode()).hexdigest()[:16]

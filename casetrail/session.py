"""Session helpers for tests, the bench and local runs.

On a cluster the deployment owns the session; library code only reads
``spark.checkpoint.dir`` from it.  ``local_session`` sets one only when unset.
"""
from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "casetrail") -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("CASETRAIL_DRIVER_MEMORY", "16g")))
    spark = with_checkpoint_dir(b).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def with_checkpoint_dir(builder: SparkSession.Builder) -> SparkSession.Builder:
    """For sessions of one machine: a scratch ``spark.checkpoint.dir`` where the
    deployment has set none.  (It can't be set on a running session.)"""
    if SparkConf().contains("spark.checkpoint.dir"):
        return builder
    return builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="casetrail-ckpt-"))

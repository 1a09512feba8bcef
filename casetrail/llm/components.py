"""Connected components over an edge table."""
from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import run_dir, store


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, component): the smallest node that links reach.

    Large-star and small-star steps by turns until no edge changes: the rounds
    grow with the logarithm of the longest chain, and no step gathers a node's
    neighbours; a hub's rows are split by the adaptive skew join.  Every round
    is stored, so an executor lost later costs one round.
    """
    spark = edges.sparkSession
    path = run_dir(spark, "components")
    e = store(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), f"{path}/0")
    state, k = None, 0
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        k += 1
        e = store(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), f"{path}/{k}")
        n, h = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if (n, h) == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = (n, h)

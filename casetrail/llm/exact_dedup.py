"""Exact dedup (native): group by a 128-bit content hash, compare bytes inside.

Texts are equal when identical after lower-casing A-Z only.  Rows are grouped
on (MD5, normalised text): the hash deals the rows out, and comparing the text
itself in the aggregation tells colliding hashes apart.  Copies meet in the
map-side half already, so a group of any size sends one row per task.  The
verdict then goes back to the rows over the narrow (MD5, SHA-256) key.

Defined results: a NULL text counts as empty; rows that share both text and
``doc_id`` are the same document and get the same verdict; a group whose ids
are all NULL keeps its NULL rows; an empty table gives an empty result; other
columns of the input are not read.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep``: "max" or "min", the id of the row that stays in each group.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("_t"))
    groups = (rows.groupBy(F.md5(F.col("_t").cast("binary")).alias("_h"), "_t")
              .agg(pick("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
              .filter("_n > 1")
              .select("_h", F.sha2(F.col("_t").cast("binary"), 256).alias("_s"), "_keep", "_n"))
    narrow = rows.select("doc_id", F.md5(F.col("_t").cast("binary")).alias("_h"),
                         F.sha2(F.col("_t").cast("binary"), 256).alias("text_sha256"))
    j = narrow.join(groups, (narrow["_h"] == groups["_h"]) & (narrow["text_sha256"] == groups["_s"]), "left")
    keep_id = F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return j.select("doc_id", keep_id.alias("keep_id"), F.coalesce("_n", F.lit(1)).alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    gone = (exact_dedup(docs, id_col, text_col, keep).filter("not kept")
            .select(F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_sha")).distinct())
    sha = F.sha2(ascii_lower(F.coalesce(docs[text_col], F.lit(""))).cast("binary"), 256)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (sha == gone["_gone_sha"]), "left_anti")

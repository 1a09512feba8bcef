"""C1 split_history: rebuild an entry log from one multi-line history cell.

Entry 0 is the registration (registrant, registration date, description).
The history is split into lines the way ``str.splitlines`` does; a line that
ends in a meta suffix ``(type:user yyyy/m/d)`` closes an entry, lines before
it are glued to it without a separator, and a dangling tail is dropped.

Everything happens inside the row with array functions (no shuffle, no UDF):
each closing line knows the index of the previous closing line, so its text
is one ``slice`` + ``array_join`` -- linear in the cell, not quadratic.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX

HISTORY_OUTPUT_COLUMNS = ["incident_id", "comment_seq", "comment_div", "comment_by",
                          "comment_date", "comment"]


def split_history(cases: DataFrame, id_col: str = "incident_id", by_col: str = "registered_by",
                  date_col: str = "registered_date", body_col: str = "description",
                  history_col: str = "comment_history") -> DataFrame:
    """C1 (with C2 per closing line); one output row per entry, numbered per input row."""
    lines = F.split(F.coalesce(F.col(history_col), F.lit("")), TX.LINE_SPLIT_PATTERN, -1)
    t = cases.select(
        F.col(id_col).alias("_id"), F.col(by_col).cast("string").alias("_by"),
        F.col(date_col).cast("string").alias("_date"), F.col(body_col).cast("string").alias("_body"),
        lines.alias("_lines"))
    # closing lines with their 0-based line index and meta suffix
    t = t.withColumn("_closing", F.filter(
        F.transform("_lines", lambda x, i: F.struct(i.alias("i"), x.alias("line"), TX.meta_of(x).alias("m"))),
        lambda s: s["m"] != F.lit("")))

    def entry(s, k):
        prev = F.when(k == 0, F.lit(-1)).otherwise(F.element_at(F.col("_closing"), k)["i"])
        carried = F.array_join(F.slice(F.col("_lines"), prev + 2, s["i"] - prev - 1), "")
        said = TX.meta_parts(s["line"], s["m"])
        return F.struct((k + 1).alias("seq"), said["type"].alias("div"), said["user"].alias("by"),
                        said["date"].alias("date"), F.concat(carried, said["text"]).alias("text"))

    first = F.struct(F.lit(0).alias("seq"), F.lit(TX.REGISTER_TYPE).alias("div"),
                     F.col("_by").alias("by"), F.col("_date").alias("date"),
                     F.col("_body").alias("text"))
    out = t.select("_id", F.explode(F.concat(F.array(first), F.transform("_closing", entry))).alias("_e"))
    return out.select(
        F.col("_id").alias("incident_id"),
        F.col("_e.seq").cast("int").alias("comment_seq"),
        F.col("_e.div").alias("comment_div"),
        F.col("_e.by").alias("comment_by"),
        F.col("_e.date").alias("comment_date"),
        F.col("_e.text").alias("comment"),
    )

"""Mixing sources to target weights (native): Efraimidis-Spirakis sampling.

Sources in code-point order (NULL last) weigh 5, 2, 1, repeating, and share
100 % of all words by weight; no target exceeds ``max_epochs`` times its
source, the excess is shared again by weight.  With w the weights and s the
sizes this is target = min(max_epochs * s, level * w); one pass over the
sources in the order of s / w finds the level.

A source takes its whole epochs first.  What is left of its target is filled
with whole documents in ascending order of -ln(u) / q, u being uniform from
the MD5 of the id and q the document's quality weight.  The last document is
the one that brings the sum nearest to the target.  Sorting a source is not
needed for that: keys fall into ``BUCKETS`` ranges, pre-aggregated map-side;
prefix sums over the ranges find the one where the target lies; and only its
documents are sorted.  The outcome is one cut-off key per source, which every
document is compared with.

Defined results: a NULL text has size 0; documents without words take 0 words;
a NULL source is a source of its own, the last; rows with the same id and size
stand or fall together; an empty table gives an empty result; other columns
are not read.  The table of sources is ordered in one task: one narrow row per
source, however many documents it holds.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, run_dir, store

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Ranges of sampling keys per source; the one that holds the target is sorted.
BUCKETS = 4096
#: Digits and symbols; the share of other characters is a document's quality.
NOISE = "0123456789#*$%&|<>"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.1 (digits and symbols only, or empty) to 1."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == 0, F.lit(0.1)).otherwise(
        F.lit(0.1) + F.lit(0.9) * F.length(F.translate(t, NOISE, "")) / F.length(t))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight, with u from 52 bits of an MD5: the same in every run."""
    h = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    d = sizes.withColumn("_w", w.cast("double")).withColumn("_cap", F.col("source_size") * float(max_epochs))
    # in the order of cap / weight: all before a row are capped, the rest share by weight
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    d = (d.withColumn("_level", (F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                      / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
         .withColumn("_fits", F.col("_level") <= F.col("_cap") / F.col("_w")))
    # the first row that its level does not fill gives the level for all after it
    level = F.min_by("_level", F.when(F.col("_fits"), F.struct(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source"))).over(whole)
    return d.withColumn("_l", level).select(
        "source", "source_size", F.least("_cap", F.coalesce(F.col("_l") * F.col("_w"), F.col("_cap"))).alias("target"))


def mix_plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS,
             max_epochs: int = MAX_EPOCHS, seed: str = SEED, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(narrow, plan): per document doc_id, source, size, _e; per source its
    target, whole epochs and cut-off key."""
    path = run_dir(docs.sparkSession, "mix")
    t = F.col(text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(t).alias("size"),
                         sampling_key(F.col(id_col), quality_weight(t), seed).alias("_e"))
    narrow = store(narrow, path).withColumn("_b", F.floor(F.exp(-F.col("_e")) * buckets))
    ranges = store(narrow.groupBy("source", "_b").agg(F.sum("size").alias("_s")), path + "-ranges")
    targets = (source_targets(ranges.groupBy("source").agg(F.sum("_s").alias("source_size")), weights, max_epochs)
               .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
               .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")))
    upto = Window.partitionBy("source").orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = ranges.withColumn("_to", F.sum("_s").over(upto)).withColumnRenamed("source", "_src")
    # the ranges are at most `buckets` rows per source, whatever its documents
    cut = (r.join(targets, r["_src"].eqNullSafe(targets["source"]))
           .filter("_to - _s < _rest and _rest <= _to")
           .select("_src", F.col("_b").alias("_cut_b"), (F.col("_rest") - F.col("_to") + F.col("_s")).alias("_left")))
    at = narrow.join(cut, narrow["source"].eqNullSafe(cut["_src"]) & (narrow["_b"] == cut["_cut_b"]))
    order = Window.partitionBy("source").orderBy("_e", F.col("doc_id").asc_nulls_last(), "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (at.withColumn("_before", before).filter(F.col("_before") + F.col("size") / 2 <= F.col("_left"))
            .groupBy("source").agg(F.max("_e").alias("_cut_e")).withColumnRenamed("source", "_lsrc"))
    c = cut.join(last, cut["_src"].eqNullSafe(last["_lsrc"]), "left").select(
        F.col("_src").alias("_csrc"), "_cut_b", "_cut_e")
    plan = targets.join(c, targets["source"].eqNullSafe(c["_csrc"]), "left").select(
        F.col("source").alias("_psrc"), "source_size", "target", "_epochs", "_cut_b", "_cut_e")
    return narrow, store(plan, path + "-plan")


def copies(bucket: Column, key: Column) -> Column:
    """How often a document is taken, after the join with the plan."""
    more = (bucket > F.col("_cut_b")) | ((bucket == F.col("_cut_b")) & (key <= F.col("_cut_e")))
    return (F.col("_epochs") + F.coalesce(more, F.lit(False)).cast("long")).cast("long")


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), copies."""
    narrow, plan = mix_plan(docs, **options)
    n = copies(F.col("_b"), F.col("_e"))
    return narrow.join(plan, narrow["source"].eqNullSafe(plan["_psrc"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: str = SEED,
                    buckets: int = BUCKETS, **options) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it.
    Documents without words add nothing to a mix and are left out."""
    _, plan = mix_plan(docs, id_col, text_col, source_col, seed=seed, buckets=buckets, **options)
    plan = plan.select(F.col("_psrc").alias("__mix_src"), *[c for c in plan.columns if c in ("_epochs", "_cut_b", "_cut_e")])
    t = docs[text_col]
    key = sampling_key(docs[id_col], quality_weight(t), seed)
    d = docs.join(plan, docs[source_col].eqNullSafe(plan["__mix_src"]))
    more = (F.floor(F.exp(-key) * buckets) > plan["_cut_b"]) | (
        (F.floor(F.exp(-key) * buckets) == plan["_cut_b"]) & (key <= plan["_cut_e"]))
    n = F.when(word_count(t) > 0, plan["_epochs"] + F.coalesce(more, F.lit(False)).cast("long")).otherwise(F.lit(0))
    d = d.select(*[docs[c] for c in docs.columns], n.cast("int").alias("__mix_n")).filter("__mix_n > 0")
    return d.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_n")))).drop("__mix_n", "__mix_copy")

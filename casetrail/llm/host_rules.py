"""Quality rules per document and per host.

Every document is measured by itself.  Its host fails with the share of its
documents that break any rule, shrunken towards the corpus: the prior is a beta
distribution with the mean and the between-host variance of the rates, so a
host of few documents is judged by the corpus and a large one by itself.  A host
loses all its documents if its posterior puts its rate over ``OUTLIER`` times the
prior's mean with a probability of 95 % (the posterior mean less ``SURE`` standard
deviations is over that limit): the limit moves with the corpus, and a host has
to have the documents to show it.

The rates are sums per host, made map-side first; the prior takes two numbers
from one row; verdicts, one narrow row per host, are joined back.  Large hosts
are split by the adaptive skew join.

Defined results: a NULL text has no words and fails; a NULL host is a host of
its own; repeated rows count each; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import run_dir, small_batches, store

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
#: Further rules, which count for the host only: symbols per 100 word characters, duplicate lines.
MAX_SYMBOL_PCT, MAX_DUP_LINES = 10, 10
#: A host fails where its rate is over this many times the corpus's, and the standard
#: deviations that make 95 % on one side.
OUTLIER, SURE = 2.0, 1.645
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("n_words", pa.int64()), ("word_chars", pa.int64()),
                     ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window which occurs twice or more."""
    if len(words) < 4:
        return 0
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    # pairs are numbered first, so that a window is one exact 64-bit key
    _, pair = np.unique(w[:-1] * len(number) + w[1:], return_inverse=True)
    _, at, n = np.unique(pair[:-1] * len(number) + w[2:], return_inverse=True, return_counts=True)
    again = n[at] > 1
    hit = np.zeros(len(w), bool)
    for k in range(3):
        hit[k:len(w) - 2 + k] |= again
    return int(hit.sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.encode().split()  # bytes split at exactly the six ASCII spaces
    chars = len(text) - sum(map(text.count, SPACES))
    lines = Counter(x for x in text.split("\n") if x.strip(SPACES)) if "\n" in text else {}
    return (len(words), chars, sum(map(text.count, SYMBOLS)), sum(lines.values()) - len(lines), repeated_words(words))


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for b in small_batches(batches):
            made = list(zip(*map(measure, b.column(2).to_pylist())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, pa.int64()) for c in made]], schema=_SCHEMA)

    return rows.mapInArrow(run, "doc_id long, host string, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def rule_failed():
    return (base_failed() | (100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars"))
            | (F.col("n_dup_lines") > MAX_DUP_LINES))


def host_rates(measures: DataFrame) -> DataFrame:
    """host, n_docs, n_failed, host_rate (the posterior mean of its failure rate),
    host_least (what the rate is over with a probability of 95 %), corpus_rate (the prior's mean)."""
    hosts = measures.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(rule_failed().cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    # n, failures, hosts and the sum of n * rate^2 give the mean and the variance
    n, f, k, q = hosts.agg(F.sum("n_docs"), F.sum("n_failed"), F.count(F.lit(1)), F.sum(F.col("n_docs") * rate * rate)).first()
    a, b = beta_prior(n or 0, f or 0, k, q or 0.0)
    mean, size = (F.col("n_failed") + a) / (F.col("n_docs") + a + b), F.col("n_docs") + a + b
    return (hosts.withColumn("host_rate", mean)
            .withColumn("host_least", mean - SURE * F.sqrt(mean * (1 - mean) / (size + 1)))
            .withColumn("corpus_rate", F.lit(a / (a + b))))


def beta_prior(n: int, failures: int, hosts: int, square: float) -> tuple[float, float]:
    """Moments: the between-host variance is the weighted variance of the rates
    less what sampling alone would make."""
    if n == 0:
        return 1.0, 1.0
    m = min(max(failures / n, 1e-6), 1 - 1e-6)
    between = max(square / n - (failures / n) ** 2 - m * (1 - m) * hosts / n, 1e-6)
    strength = min(max(m * (1 - m) / between - 1, 1.0), 1e6)
    return m * strength, (1 - m) * strength


def host_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  outlier: float = OUTLIER) -> DataFrame:
    """The measures of each document, base_failed, kept, and its host's rate."""
    m = store(text_measures(docs, id_col, text_col, host_col), run_dir(docs.sparkSession, "hosts"))
    rates = host_rates(m).select(F.col("host").alias("_h"), "host_rate", (F.col("host_least") > outlier * F.col("corpus_rate")).alias("_fails"))
    j = m.join(rates, m["host"].eqNullSafe(rates["_h"]))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"),
                    (~base_failed() & ~F.col("_fails")).alias("kept"), "host_rate")

"""Token counts by a two-tier lookup of pre-token lengths on the map side.

A byte-level BPE never merges across its pre-tokens, and a single space before
a word always starts one.  So a text is cut at single spaces into such pieces
(a word with its space and its punctuation), and its count is the sum of theirs:

1. a broadcast table has the counts of the parts (see 2) of the ``TABLE_WORDS`` most
   frequent pieces.  Each task sums up its pieces in a Misra-Gries summary of fixed size;
   the summaries are merged on the executors in rounds, so no task holds more
   than a fixed number of them and the driver gets one.  All documents take part;
2. a batch's distinct pieces are cut into words and the marks and line ends behind
   them, so that a word is known whatever mark follows.  A part that is not in the
   table goes through the cache of the worker, and from there to the tokenizers library.

The tables only save time: a count never depends on them.  No pre-token rows
are shuffled, only one summary per task.

Defined results: NULL counts as empty, with 0 bytes and 0 tokens; texts of any
length are counted whole, piece by piece; repeated rows are counted each;
an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunked
from .common import small_batches
from .word_cache import CACHE_CHARS, WordCache, token_numbers, worker_cache

#: Entries of the broadcast table: about 2 MB, whatever the corpus.
TABLE_WORDS = 65_536
#: Counters of a task's summary, and summaries merged by one task.
SUMMARY_WORDS, FAN_IN = 16_384, 64
LIMIT = 1024

_run = re.compile(r"\s\s")
_cut = re.compile(r"(?<=\S) (?=\S)")

#: What is put between parts: behind a letter before an ASCII mark (no apostrophe) or line end,
#: and behind a mark's line end before a letter, where a new pre-token starts whatever lies around.
_BREAK, _LETTER = "\x01", "A-Za-zÀ-ÖØ-öø-ɏ"
_BREAKS = (rf"([{_LETTER}])([\n!-&(-/:-@\[-^`{{-~])", rf"([!-~]\n)([{_LETTER}])")


def pieces(text: str) -> list[str]:
    """``text`` cut before single spaces between words; all but the first piece
    start with the space."""
    if not text:
        return []
    plain = _run.search(text) is None and not text[0].isspace() and not text[-1].isspace()
    parts = text.split(" ") if plain else _cut.split(text)
    return [parts[0], *map(" ".__add__, parts[1:])]


def parts(found: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(starts, codes, parts): piece i is the join of ``parts[c]`` for c in
    ``codes[starts[i]:starts[i + 1]]``.  Pieces that may hold a special string stay whole."""
    given = pa.array(found, pa.large_string())
    if pc.any(pc.match_substring(given, _BREAK)).as_py():
        return np.arange(len(found) + 1), np.arange(len(found)), found
    cut = given
    for at in _BREAKS:
        cut = pc.replace_substring_regex(cut, at, rf"\1{_BREAK}\2")
    cut = pc.split_pattern(pc.if_else(pc.match_substring(given, "<|"), given, cut), _BREAK)
    coded, starts = cut.flatten().dictionary_encode(), np.asarray(cut.offsets).astype(np.int64)
    return starts - starts[0], np.asarray(coded.indices), coded.dictionary.to_pylist()


def counted(texts: pa.Array, cache: WordCache) -> np.ndarray:
    """The tokens of each text, by the counts of its parts."""
    at, codes, found = chunked(texts)
    starts, part, words = parts(found)
    of_parts = np.concatenate([[0], np.cumsum(np.array(cache.values(words), np.int64)[part])]) if words else np.zeros(1, np.int64)
    return np.diff(np.concatenate([[0], np.cumsum(np.diff(of_parts[starts])[codes])])[at])


def shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries: keep ``size`` counters at most, less what the others count."""
    if len(counts) <= size:
        return counts
    off = sorted(counts.values(), reverse=True)[size]
    return Counter({w: n - off for w, n in counts.items() if n > off})


def _row(counts: Counter):
    return pa.RecordBatch.from_pydict({"words": [list(counts)], "counts": [list(counts.values())]},
                                      schema=pa.schema([("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]))


def _merge(batches):
    total: Counter = Counter()
    for b in batches:
        for r in b.to_pylist():
            total.update(dict(zip(r["words"], r["counts"])))
            total = shrink(total, TABLE_WORDS)
    yield _row(total)


def frequent_pieces(texts: DataFrame, size: int = TABLE_WORDS) -> list[str]:
    """The most frequent pieces by the merged summaries, most frequent first."""
    def summary(batches):
        total: Counter = Counter()
        for b in small_batches(batches):
            for t in b.column(0).to_pylist():
                total.update(pieces(t))
            if len(total) > 8 * SUMMARY_WORDS:
                total = shrink(total, SUMMARY_WORDS)
        yield _row(shrink(Counter({w: n for w, n in total.items() if len(w) <= CACHE_CHARS}), SUMMARY_WORDS))

    schema = "words array<string>, counts array<long>"
    rows = texts.mapInArrow(summary, schema)
    # one summary per task: 64 of them to a merging task, and so on until one is left
    n = texts.rdd.getNumPartitions()
    while True:
        n = -(-n // FAN_IN)
        rows = rows.repartition(max(n, 1)).mapInArrow(_merge, schema)
        if n <= 1:
            break
    total: Counter = Counter()
    for r in rows.collect():
        total.update(dict(zip(r["words"], r["counts"])))
    total = shrink(total, size)
    return [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text", table_words: int = TABLE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    words = frequent_pieces(rows.select("text"), table_words)
    words = parts(words)[2]
    counts = list(token_numbers(tokenizer_path, words))
    table, run = spark.sparkContext.broadcast((words, counts)), uuid.uuid4().hex

    def count(batches):
        cache = worker_cache(("counts", tokenizer_path, run), lambda: WordCache(
            lambda new: token_numbers(tokenizer_path, new), dict(zip(*table.value))))
        for b in small_batches(batches):
            n = counted(b.column(0), cache)
            yield pa.RecordBatch.from_arrays([b.column(1), pc.binary_length(b.column(0)).cast(pa.int64()),
                                              pa.array(n, pa.int64()), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Alignment of two tokenizers' tokens by interval coalescing.

A text behind one space is cut into tokens by A (byte-level BPE) and by B (a
piece model, which adds that space itself).  Both cut the same bytes:

* all tokens of both are sorted by where they start (``lexsort``).  The running
  maximum of their ends (``maximum.accumulate``) tells where a group ends: a
  token that starts at the maximum or behind it opens the next group.  Within a
  group, each A token is linked to the B tokens whose bytes overlap its own;
* a pair's count is the number of documents that hold it linked.  Tasks add up
  the pairs of their documents, and only sums are shuffled;
* counts come back to the documents in two tiers.  The most frequent pairs,
  ``TABLE_PAIRS`` at most, are broadcast.  A document's rarer pairs are joined with
  the counts by pair, one narrow row each, and summed per document.  Both tiers
  are exact, and the second takes whatever the first does not hold.

Neither tokenizer merges across a single space between words, so the distinct
chunks of a batch (``chunks``) are tokenized and aligned, all in one sort, and a
worker remembers the frequent ones.  What is kept of a document between the two
passes (its pairs) is written to the shared folder.

Defined results: a NULL or empty text, and one whose tokens of A or B do not
join to its bytes (a marker character U+2581 in it, say), has no tokens: zeros
and ''.  Texts of any length are aligned whole.  Repeated rows count as one
document each; rows are known by where they were read, so NULL and repeated ids
keep their rows.  An empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .chunks import chunked, gathered
from .common import run_dir, small_batches, written
from .word_cache import ENCODE_CHARS, WordCache, worker_cache

#: Pairs that are broadcast at most: 9 bytes each.
TABLE_PAIRS = 1 << 20
#: Pairs that a task holds before it adds them up, and bytes of pairs read at once.
HELD_PAIRS, READ_BYTES = 1 << 22, 16 << 20
#: Chunks that a worker remembers, and that are aligned in one sort.
CACHE_CHUNKS, SORTED_CHUNKS = 200_000, 20_000
#: Bytes of documents handled at once.
BLOCK_BYTES = 4 << 20
#: A pair is id A * 2^32 + id B.
SHIFT = 32


def byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other
    bytes for U+0100 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both libraries, and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        with open(a_path, encoding="utf-8") as f:
            parts = json.load(f)
        cut = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError(f"{a_path} is no plain byte-level tokenizer: texts can't be cut at spaces")
        del parts
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_of_letter()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece has a marker behind another character: texts can't be cut at spaces")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for chunks that begin with a space."""
        a, i = [], 0
        while i < len(chunks):  # encodings take many times their text: a few at once
            j, n = i, 0
            while j < len(chunks) and (j == i or n + len(chunks[j]) <= ENCODE_CHARS):
                n, j = n + len(chunks[j]), j + 1
            a += [e.ids for e in self.a.encode_batch_fast(chunks[i:j], add_special_tokens=False)]
            i = j
        return a, self.b.encode([c[1:] for c in chunks], num_threads=1)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the row that each belongs to."""
    return (np.fromiter((i for x in lists for i in x), np.int64),
            np.repeat(np.arange(len(lists)), [len(x) for x in lists]))


def coalesce(a_ends: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray):
    """Group of every A and B token, and for each A token the B tokens [lo, hi)
    that overlap it.  Each side's intervals are given in order."""
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    order = np.lexsort((np.arange(len(starts)), starts))  # by start, A before B
    reach = np.maximum.accumulate(ends[order])
    opens = np.concatenate([[True], starts[order][1:] >= reach[:-1]]) if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    lo = np.searchsorted(b_ends, a_starts, "right")
    hi = np.searchsorted(b_starts, a_ends, "left")
    return group[:len(a_starts)], group[len(a_starts):], lo, hi


class Aligner:
    """chunk -> its tokens' numbers, groups and links; kept within bounds."""

    def __init__(self, a_path: str, b_path: str):
        self.tokens = Tokenizers(a_path, b_path)
        self.a_size = np.array([len(x) for x in self.tokens.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.tokens.b_bytes], np.int64)
        #: by 3 * id + separator: the id as text with what follows it
        self.texts = [f"{i}{s}" for i in range(max(len(self.a_size), len(self.b_size))) for s in ",|;"]
        self.cache = WordCache(self._pieces, limit=CACHE_CHUNKS)

    def _pieces(self, chunks: list[str]):
        for i in range(0, len(chunks), SORTED_CHUNKS):
            yield from self.align(chunks[i:i + SORTED_CHUNKS])

    def align(self, chunks: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, text of the groups, linked pairs as bytes) of
        each chunk; n_a is -1 where the tokens do not join to it."""
        a_lists, b_lists = self.tokens.encode(chunks)
        a_bytes, b_bytes = self.tokens.a_bytes, self.tokens.b_bytes
        raw = [c.encode() for c in chunks]
        good = [b"".join([a_bytes[i] for i in a]) == r == b"".join([b_bytes[i] for i in b])
                for a, b, r in zip(a_lists, b_lists, raw)]
        (a, a_row), (b, b_row) = (_flat([x if g else [] for x, g in zip(lists, good)]) for lists in (a_lists, b_lists))
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])  # good chunks one behind the other
        a_starts, b_starts = a_ends - self.a_size[a], b_ends - self.b_size[b]
        a_group, b_group, lo, hi = coalesce(a_ends, a_starts, b_starts, b_ends)
        n_links = hi - lo
        at = np.arange(n_links.sum()) - np.repeat(np.cumsum(n_links) - n_links, n_links) + np.repeat(lo, n_links)
        pairs = (np.repeat(a, n_links) << SHIFT | b[at]).astype("<i8").tobytes()
        # ids in the order group, side, start; each with what follows it
        ids, group, side = np.concatenate([a, b]), np.concatenate([a_group, b_group]), np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((side, group))
        ids, group, side = ids[order], group[order], side[order]
        follows = np.full(len(ids), 2)
        follows[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        texts = [self.texts[k] for k in (3 * ids + follows).tolist()]
        rows = np.arange(len(chunks) + 1)
        a_at, b_at = np.searchsorted(a_row, rows), np.searchsorted(b_row, rows)
        p_at = 8 * np.concatenate([[0], np.cumsum(n_links)])[a_at]
        t_at, bounds = (a_at + b_at).tolist(), np.concatenate([a_group, [group[-1] + 1 if len(group) else 0]])[a_at].tolist()
        a_at, b_at, p_at = a_at.tolist(), b_at.tolist(), p_at.tolist()
        return [(a_at[i + 1] - a_at[i] if g else -1, b_at[i + 1] - b_at[i], bounds[i + 1] - bounds[i],
                 "".join(texts[t_at[i]:t_at[i + 1]]).encode(), pairs[p_at[i]:p_at[i + 1]]) for i, g in enumerate(good)]


_DOCS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
_DOC_TYPE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                       ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
                       ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32())), ("groups", pa.string())])


def aligned(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: its numbers of tokens, groups and links, and its
    distinct linked pairs with how often each occurs in it; ``with_groups`` adds
    the groups' text itself."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([f for f in _DOC_TYPE if with_groups or f.name != "groups"])

    def align(batches):
        aligner = worker_cache(("align", a_path, b_path), lambda: Aligner(a_path, b_path))
        row = TaskContext.get().partitionId() << 33
        for b in small_batches(batches, BLOCK_BYTES):
            out = []
            starts, codes, chunks = chunked(b.column(1), lead=True)
            known = aligner.cache.values(chunks)
            n_a, n_b, n_groups = (np.array([k[i] for k in known], np.int64)[codes] for i in range(3))
            text, text_at = gathered([k[3] for k in known], codes)
            pairs, pair_at = gathered([k[4] for k in known], codes)
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (n_a, n_b, n_groups, n_a < 0)]
            for i, (s, e) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                a, b_, g, bad = (int(x[e] - x[s]) for x in sums)
                if bad or (e - s == 1 and chunks[codes[s]] == " "):
                    a, b_, g, held, joined = 0, 0, 0, np.zeros(0, np.int64), ""
                else:
                    held = np.frombuffer(pairs[pair_at[s]:pair_at[e]], "<i8")
                    joined = text[text_at[s]:text_at[e] - 1]
                distinct, times = np.unique(held, return_counts=True)
                out.append((row, b.column(0)[i].as_py(), a, b_, g, len(held), hashlib.sha256(joined).hexdigest() if joined else "",
                            distinct, times.astype(np.int32), bytes(joined).decode() if joined else ""))
                row += 1
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(align, _DOCS + (", groups string" if with_groups else ""))


def _tables(batches, *names):
    """Batches of rows cut by the size of their lists, as numpy arrays with each row's first place."""
    for b in small_batches(batches, READ_BYTES):
        first = b.column(b.schema.names.index(names[0]))
        yield b, np.asarray(first.offsets).astype(np.int64), *(
            np.asarray(b.column(b.schema.names.index(n)).flatten()) for n in names)


def pair_counts(documents: DataFrame) -> DataFrame:
    """pair, n: how many documents hold the pair.  Tasks add up first."""
    def add(batches):
        held, size = [], 0

        def summed():
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in held])).astype(np.int64)
        for _, _, pairs in _tables(batches, "pairs"):
            held.append((pairs, np.ones(len(pairs), np.int64)))
            size += len(pairs)
            if size >= HELD_PAIRS:
                held = [summed()]
                size = len(held[0][0])
                if size >= HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed()], names=["pair", "n"])

    return (documents.select("pairs").mapInArrow(add, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def frequent_pairs(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose counts lie above the lowest level that leaves ``limit``
    of them at most: sorted pairs, and count * 2 + best.  Levels are eighths of a
    doubling, so a few hundred rows tell them."""
    level = F.floor(8 * F.log2("n")).cast("int")
    sizes = sorted(((r["level"], r["k"]) for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect()),
                   reverse=True)
    least, total = None, 0
    for lv, k in sizes:
        if total + k > limit:
            break
        least, total = lv, total + k
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    t = counts.filter(level >= least).select("pair", (2 * F.col("n") + F.col("best").cast("long")).alias("v")).toArrow()
    pair, v = (np.asarray(t.column(n).combine_chunks()) for n in ("pair", "v"))
    order = np.argsort(pair)
    return pair[order], v[order]


def align_tokens(docs: DataFrame, a_path: str, b_path: str, table_pairs: int = TABLE_PAIRS, with_groups: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the
    highest of their A id), count_sum (over links), groups_sha256."""
    spark = docs.sparkSession
    path = run_dir(spark, "alignment")
    documents = written(aligned(docs, a_path, b_path, with_groups, id_col, text_col), f"{path}/documents")
    summed = written(pair_counts(documents), f"{path}/sums")
    # one row per A id: no more than its vocabulary has
    best = summed.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("most"))
    counts = written(summed.join(F.broadcast(best), F.shiftright("pair", SHIFT) == F.col("a"))
                   .select("pair", "n", (F.col("n") == F.col("most")).alias("best")), f"{path}/counts")
    table = spark.sparkContext.broadcast(frequent_pairs(counts, table_pairs))
    extra = ["groups"] if with_groups else []

    def look_up(batches):
        keys, found = table.value
        for b, at, pairs, times in _tables(batches, "pairs", "times"):
            at = at - at[0]
            k = np.searchsorted(keys, pairs)
            inside = k < len(keys)
            hit = np.zeros(len(pairs), bool)
            hit[inside] = keys[k[inside]] == pairs[inside]
            v = np.zeros(len(pairs), np.int64)
            v[hit] = found[k[hit]]
            total, best, rare = (np.concatenate([[0], np.cumsum(x)])[at] for x in ((v >> 1) * times, (v & 1) * times, ~hit))
            lists = pa.array(rare.astype(np.int32))
            left = [pa.ListArray.from_arrays(lists, pa.array(x[~hit])) for x in (pairs, times)]
            kept = [b.column(i) for i, n in enumerate(b.schema.names) if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(total)), pa.array(np.diff(best)), *left],
                                             names=[f.name for f in looked])

    looked = [f for f in documents.schema if f.name not in ("pairs", "times")] + [
        StructField("table_sum", LongType()), StructField("table_best", LongType()), documents.schema["pairs"],
        documents.schema["times"]]
    found = written(documents.mapInArrow(look_up, StructType(looked)), f"{path}/found")
    rare = (found.filter(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")))
    rest = (rare.join(counts, "pair").groupBy("row")
            .agg(F.sum(F.col("n") * F.col("times")).alias("rare_sum"),
                 F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best")))
    return found.drop("pairs", "times").join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("table_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("table_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256", *extra)

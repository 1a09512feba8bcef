"""Byte-level BPE encoding and decoding by replaying the merges on a corpus.

A block of documents is a corpus of distinct pre-tokens.  Those that the worker
has not met yet are laid out in one array of byte tokens, linked to their
neighbours, with an inverted index from the rank of a token pair to the
positions that it stands at.  The merges are then applied to the whole corpus in
the order of their ranks: all positions of the lowest rank that occurs, then
the next.  A merge looks up only the two pairs that it makes with its
neighbours, and enters them in the index.  Where such a pair ranks below the
merge itself, it goes first and the remaining positions wait, so that each word
sees its merges in the order that the reference algorithm (lowest rank, then
leftmost) gives it.  A pre-token that is an entry of the vocabulary is that id.
A pattern that does not start a match at single spaces gets its texts uncut.

The corpus of a replay is a block, not a shuffle of all words: words are never
sent to another task and back, tasks do not depend on each other, and a
worker's memory of replayed chunks (bounded) serves all its blocks.  No row is
shuffled.

Defined results: a NULL or empty text has no ids and decodes to no bytes; texts
and words of any length are encoded whole; rows are independent of each other,
so repeated rows and NULL ids give one row each; an empty table gives an empty
result; other columns are not read.
"""
from __future__ import annotations

import base64
import hashlib
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunked, gathered
from .common import small_batches
from .word_cache import WordCache, worker_cache


#: Pre-tokens and chunks (a pre-token or several between two spaces) that a worker remembers.
CACHE_WORDS, CACHE_CHUNKS = 400_000, 500_000
#: Bytes of documents to a block.
BLOCK_BYTES = 8 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


class MergeTable:
    """Ranks of a vocabulary by bytes and, as they are asked for, by pair of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.token[r] = b
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        #: by two bytes: the rank of their pair, -1 for none
        self.bytes = np.array([[ranks.get(bytes([i, j]), -1) for j in range(256)] for i in range(256)], np.int64)
        self.pairs: dict[int, int] = {}  # left * 2^32 + right -> rank, -1 for none
        self.vocabulary = pa.array(self.token, pa.large_binary())

    def pair(self, left: int, right: int) -> int:
        key = left << 32 | right
        rank = self.pairs.get(key)
        if rank is None:
            rank = self.ranks.get(self.token[left] + self.token[right], -1)
            if len(self.pairs) >= 1 << 20:
                self.pairs.clear()
            self.pairs[key] = rank
        return rank


def replay(words: list[bytes], table: MergeTable) -> list[np.ndarray]:
    """The ids of every word, by one replay of the merges over all of them."""
    ids, at = replay_all(words, table)
    return [ids[s:e] for s, e in zip(at, at[1:])]


def replay_all(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, list[int]]:
    """The ids of all words, one after the other, and where each word's begin (one more at the end)."""
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words]).astype(np.int64)
    if len(data) == 0:
        return np.zeros(0, "<u4"), [0] * (len(words) + 1)
    n = len(data)
    # a word's last token has no neighbour to the right: n stands for none, -1 to the left
    token = table.single[data].tolist()
    right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
    starts = np.concatenate([[0], ends[:-1]])
    filled = ends > starts
    right[ends[filled] - 1] = n
    left[starts[filled]] = -1
    ranked = np.where(right < n, table.bytes[data, np.append(data[1:], 0)], -1)
    order = np.argsort(ranked, kind="stable")[(ranked < 0).sum():]
    held, at = np.unique(ranked[order], return_index=True)
    order = order.tolist()
    index = {r: order[a:b] for r, a, b in zip(held.tolist(), at.tolist(), [*at[1:].tolist(), len(order)])}
    # the rank of the pair that begins at a position, -1 for none
    ranked, right, left = ranked.tolist(), right.tolist(), left.tolist()
    pair, known, listed = table.pair, table.pairs.get, index.get
    queue = list(index)
    heapify(queue)
    while queue:
        rank = heappop(queue)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        for k, i in enumerate(places):
            if ranked[i] != rank:
                continue  # merged away since it was entered
            j, before, least = right[i], left[i], rank
            after = right[j]
            token[i], token[j] = rank, -1
            right[i], ranked[i], ranked[j] = after, -1, -1
            if after < n:
                left[after] = i
                r = known(rank << 32 | token[after])
                if r is None:
                    r = pair(rank, token[after])
                if r >= 0:
                    ranked[i] = r
                    others = listed(r)
                    if others is None:
                        index[r] = [i]
                        heappush(queue, r)
                    else:
                        others.append(i)
                    if r < least:
                        least = r
            if before >= 0:
                r = known(token[before] << 32 | rank)
                if r is None:
                    r = pair(token[before], rank)
                ranked[before] = r
                if r >= 0:
                    others = listed(r)
                    if others is None:
                        index[r] = [before]
                        heappush(queue, r)
                    else:
                        others.append(before)
                    if r < least:
                        least = r
            if least < rank and k + 1 < len(places):
                index[rank] = places[k + 1:]
                heappush(queue, rank)
                break
    token = np.array(token)
    alive = token >= 0
    at = np.concatenate([[0], np.cumsum(alive)])
    return token[alive].astype("<u4"), at[np.append(starts, n)].tolist()


def cuts_at_spaces(pattern: regex.Pattern) -> bool:
    """Whether a single space between two other characters starts a new match:
    asked for every pair of kinds of characters."""
    kinds = ["a", "B", "é", "日", "7", "½", ",", "'", "'s", "$", "🙂", "\u0301", "\x1c", "\x00"]
    found = pattern.findall
    return all(found(f"{x} {y}") == found(x) + found(f" {y}") for x in kinds for y in kinds)


class ReplayEncoder:
    """Ids of texts; keeps what it has replayed, within bounds."""

    def __init__(self, table: MergeTable, pattern: str):
        self.table, self.pattern = table, regex.compile(pattern)
        self.cut = cuts_at_spaces(self.pattern)
        self.words = WordCache(self._replayed, limit=CACHE_WORDS)
        self.chunks = WordCache(self._split, limit=CACHE_CHUNKS)

    def _replayed(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        whole = list(map(self.table.ranks.get, raw))
        ids, at = replay_all([w for w, i in zip(raw, whole) if i is None], self.table)
        data = ids.tobytes()
        rest = (data[4 * s:4 * e] for s, e in zip(at, at[1:]))
        return [next(rest) if i is None else i.to_bytes(4, "little") for i in whole]

    def _split(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.pattern.findall, chunks))
        ids, out, at = self.words.values(list(chain.from_iterable(found))), [], 0
        for f in found:
            n = len(f)
            out.append(ids[at] if n == 1 else b"".join(ids[at:at + n]))
            at += n
        return out

    def encode(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """All ids (little-endian, 32 bits) and each text's first byte among them."""
        if self.cut:
            starts, codes, chunks = chunked(texts)
        else:  # each text is a chunk
            chunks = [t or "" for t in texts.to_pylist()]
            starts, codes = np.arange(len(chunks) + 1), np.arange(len(chunks))
        data, at = gathered(self.chunks.values(chunks), codes)
        return data, at[starts]

    def decode(self, ids: memoryview) -> tuple[memoryview, np.ndarray]:
        """The bytes of all ids and where each id's bytes begin."""
        taken = self.table.vocabulary.take(pa.array(np.frombuffer(ids, "<u4")))
        n = len(taken)
        return (memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64, n + 1)) if n else (
            memoryview(b""), np.zeros(1, np.int64))


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                  ("decoded_sha256", pa.string()), ("ids", pa.binary()), ("decoded", pa.binary())])


def replay_tokens(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; ``with_ids`` adds the ids
    (little-endian, 32 bits) and the decoded bytes themselves."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([f for f in _OUT if with_ids or f.name not in ("ids", "decoded")])

    def encode(batches):
        coder = worker_cache(("replay", ranks_path, pattern), lambda: ReplayEncoder(MergeTable(load_ranks(ranks_path)), pattern))
        for b in small_batches(batches, BLOCK_BYTES):
            ids, at = coder.encode(b.column(1))
            raw, begin = coder.decode(ids)
            cuts = begin[at // 4].tolist()
            at = at.tolist()
            spans = list(zip(at, at[1:], cuts, cuts[1:]))
            columns = [b.column(0), pa.array([(e - s) // 4 for s, e, _, _ in spans], pa.int64()),
                       pa.array([hashlib.sha256(ids[s:e]).hexdigest() for s, e, _, _ in spans]),
                       pa.array([hashlib.sha256(raw[s:e]).hexdigest() for _, _, s, e in spans])]
            if with_ids:
                columns += [pa.array([bytes(ids[s:e]) for s, e, _, _ in spans], pa.binary()),
                            pa.array([bytes(raw[s:e]) for _, _, s, e in spans], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    names = {"doc_id": "long", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "ids": "binary",
             "decoded": "binary"}
    return rows.mapInArrow(encode, ", ".join(f"{f.name} {names[f.name]}" for f in schema))

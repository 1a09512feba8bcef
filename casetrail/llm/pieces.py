"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a ``.model`` file.  A text gets a
leading marker, spaces become markers (U+2581), and the segmentation with the
highest sum of scores wins; of equal ones, the one whose last differing piece
begins first.  A character without a piece costs
``UNKNOWN_PENALTY`` more than the worst piece and becomes byte pieces.
Decoding joins the pieces' bytes, turns markers into spaces and drops the
leading one.

No piece of such a model has a marker after another character, so the best
segmentation of a text is that of its words (markers and what follows them),
one by one.  Each worker keeps words that it has segmented, above all those that recur.

Defined results: NULL and empty texts have no ids and decode to the empty
text; a marker character in the text comes back as a space, as in the library;
texts of any length are encoded whole; rows are independent of each other, so
repeated rows give equal results; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import gathered
from .common import small_batches
from .word_cache import RecurringCache, worker_cache

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Words segmented in step (each takes some 2 kB then), and bytes of texts taken at once.
STEP_WORDS, BLOCK_BYTES = 4096, 1 << 18
#: Words that a worker remembers.
KNOWN_WORDS = 240_000
_word = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


@dataclass
class Pieces:
    """Double-array trie over the UTF-8 of the pieces: from node s, byte b leads
    to t = base[s] + b + 1 if check[t] == s; value[t] is a piece's id or -1."""
    base: list
    check: list
    value: list
    score: list       # by id
    text: list        # by id: the bytes that it decodes to
    byte_id: list     # by byte: the id of its byte piece
    unknown: float    # score of a character without a piece

    def arrays(self):
        if not hasattr(self, "_arrays"):
            self._arrays = tuple(np.array(x) for x in (self.base, self.check, self.value, self.score))
        return self._arrays


def load_pieces(model_path: str) -> Pieces:
    """Read a model file by the library and build the trie (on the driver; its
    size is that of the vocabulary)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.vocab_size()
    text, score, byte_id, keys = [b""] * n, [0.0] * n, [0] * 256, {}
    for i in range(n):
        piece, score[i] = sp.id_to_piece(i), sp.get_score(i)
        if sp.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            text[i] = bytes([int(piece[3:5], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            if re.search(f"[^{MARKER}]{MARKER}", piece):
                raise ValueError(f"piece {piece!r} has a marker after another character")
            keys[piece.encode()] = i
            text[i] = piece.replace(MARKER, " ").encode()
    base, check, value = double_array(keys)
    return Pieces(base, check, value, score, text, byte_id, min(score[i] for i in keys.values()) - UNKNOWN_PENALTY)


def double_array(keys: dict[bytes, int]) -> tuple[list, list, list]:
    """base, check and value of the trie over ``keys``; the root is node 0."""
    children: list[dict[int, int]] = [{}]  # a plain trie first
    ends = [-1]
    for key, v in keys.items():
        s = 0
        for b in key:
            if b not in children[s]:
                children[s][b] = len(children)
                children.append({})
                ends.append(-1)
            s = children[s][b]
        ends[s] = v
    size = 2 * len(children) + 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0], place, free, wide = 0, {0: 0}, 257, 257  # below, high bytes reach no slot
    for s in range(len(children)):
        offs = sorted(children[s])
        at = place[s]
        value[at] = ends[s]
        if not offs:
            continue
        while check[free] != -1:
            free += 1
        # one child takes the first free slot; several search on from where the last did
        b = max(0, (free if len(offs) == 1 else max(free, wide)) - offs[0] - 1)
        tried = 0
        while True:
            if b + 260 > len(check):
                base, check, value = base + [0] * size, check + [-1] * size, value + [-1] * size
            if all(check[b + c + 1] == -1 for c in offs):
                break
            b, tried = b + 1, tried + 1
        if tried > 32:
            wide = b + offs[0] + 1
        base[at] = b
        for c in offs:
            check[b + c + 1] = at
            place[children[s][c]] = b + c + 1
    return base, check, value


def segment(p: Pieces, word: str) -> list[int]:
    """The ids of the best segmentation of one word (markers included)."""
    data = word.encode()
    n = len(data)
    best: list = [None] * (n + 1)
    best[0] = 0.0
    start, piece = [0] * (n + 1), [-1] * (n + 1)
    base, check, value, score = p.base, p.check, p.value, p.score
    for i in range(n):
        have = best[i]
        if have is None:
            continue
        lead = data[i]
        char = i + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
        node, single = 0, False
        for j in range(i, n):
            t = base[node] + data[j] + 1
            if check[t] != node:
                break
            node = t
            v = value[t]
            if v >= 0:
                s = have + score[v]
                if best[j + 1] is None or s > best[j + 1]:
                    best[j + 1], start[j + 1], piece[j + 1] = s, i, v
                single = single or j + 1 == char
        if not single:
            s = have + p.unknown
            if best[char] is None or s > best[char]:
                best[char], start[char], piece[char] = s, i, -1
    out: list[int] = []
    while n:
        i = start[n]
        out.extend([piece[n]] if piece[n] >= 0 else [p.byte_id[b] for b in reversed(data[i:n])])
        n = i
    return out[::-1]


def segment_many(p: Pieces, new: list[str], longest: int = 48) -> list[list[int]]:
    """:func:`segment` of many words in step: the trie is walked from one start
    position of all words at once.  Words over ``longest`` bytes go one by one."""
    raw = [w.encode() for w in new]
    out = [segment(p, w) if len(r) > longest else None for w, r in zip(new, raw)]
    todo = [i for i, x in enumerate(out) if x is None]
    if not todo:
        return out
    size = np.array([len(raw[i]) for i in todo])
    width = int(size.max())
    data = np.frombuffer(b"".join(raw[i].ljust(width, b"\0") for i in todo), np.uint8).reshape(len(todo), width).astype(np.int64)
    base, check, value, score = p.arrays()
    best = np.full((len(todo), width + 1), -np.inf)
    best[:, 0] = 0.0
    start, piece = np.zeros((len(todo), width + 1), np.int64), np.full((len(todo), width + 1), -1)
    for i in range(width):
        rows = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
        if not len(rows):
            continue
        lead = data[rows, i]
        char = i + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        single, at, node = np.zeros(len(rows), bool), np.arange(len(rows)), np.zeros(len(rows), np.int64)
        for j in range(i, width):
            t = base[node] + data[rows[at], j] + 1
            on = (check[t] == node) & (size[rows[at]] > j)
            at, node = at[on], t[on]
            if not len(at):
                break
            v = value[node]
            hit = v >= 0
            r, v = rows[at[hit]], v[hit]
            s = best[r, i] + score[v]
            better = s > best[r, j + 1]
            r, v = r[better], v[better]
            best[r, j + 1], start[r, j + 1], piece[r, j + 1] = s[better], i, v
            single[at[hit]] |= char[at[hit]] == j + 1
        r, c = rows[~single], char[~single]
        s = best[r, i] + p.unknown
        better = s > best[r, c]
        best[r[better], c[better]], start[r[better], c[better]], piece[r[better], c[better]] = s[better], i, -1
    for k, i in enumerate(todo):
        n, ids, from_, which = len(raw[i]), [], start[k].tolist(), piece[k].tolist()
        while n:
            a = from_[n]
            ids.extend([which[n]] if which[n] >= 0 else [p.byte_id[b] for b in reversed(raw[i][a:n])])
            n = a
        out[i] = ids[::-1]
    return out


class Segmenter:
    """The pieces of a model, and the words that a worker has segmented by them."""

    def __init__(self, p: Pieces):
        self.p, self.is_byte = p, np.zeros(len(p.text), bool)
        self.is_byte[p.byte_id] = True
        self.text = pa.array(p.text, pa.large_binary())
        self.cache = RecurringCache(self._packed, KNOWN_WORDS)

    def _packed(self, new: list[str]):
        for i in range(0, len(new), STEP_WORDS):
            for ids in segment_many(self.p, new[i:i + STEP_WORDS]):
                yield np.asarray(ids, "<u4").tobytes()


def words(text: str) -> list[str]:
    return _word.findall(MARKER + text.replace(" ", MARKER)) if text else []


def decode(p: Pieces, ids) -> str:
    return b"".join(map(p.text.__getitem__, ids)).decode("utf-8", "replace")[1:]


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """doc_id, n_chars, n_ids, n_byte_ids, ids_crc32 (of little-endian 32-bit
    ids), decoded_crc32 (of the decoded text's UTF-8), round_trip (decoding
    gives the text again), and the ``ids`` and ``decoded`` text on demand."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(load_pieces(model_path))
    with open(model_path, "rb") as f:  # runs over one model share a worker's segmenter
        key = ("pieces", hashlib.md5(f.read()).hexdigest())
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    more = [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_ids", pa.int64()), ("n_byte_ids", pa.int64()),
                        ("ids_crc32", pa.int64()), ("decoded_crc32", pa.int64()), ("round_trip", pa.bool_()), *more])

    def encode(batches):
        known = worker_cache(key, lambda: Segmenter(model.value))
        for b in small_batches(batches, BLOCK_BYTES):
            texts = b.column(0).to_pylist()
            cut = [words(t) for t in texts]
            made = known.cache.values([w for ws in cut for w in ws])  # words of all texts of the batch at once
            # where each text's ids begin, and the last end
            at = np.concatenate([[0], np.cumsum([len(m) for m in made], dtype=np.int64)])[
                np.concatenate([[0], np.cumsum([len(ws) for ws in cut])])] // 4
            raw = b"".join(made)
            ids = np.frombuffer(raw, "<u4")
            data, ends = gathered(known.text, ids)
            byte_ids = np.concatenate([[0], np.cumsum(known.is_byte[ids])])[at]
            back = [bytes(data[i:j]).decode("utf-8", "replace")[1:] for i, j in pairwise(ends[at].tolist())]
            columns = [b.column(1), [len(t) for t in texts], np.diff(at), np.diff(byte_ids),
                       [zlib.crc32(raw[4 * i:4 * j]) for i, j in pairwise(at.tolist())], [zlib.crc32(t.encode()) for t in back],
                       [t == u for t, u in zip(texts, back)]]
            if with_ids:
                columns += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.view("<i4"))), back]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    ddl = "doc_id long, n_chars long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    return rows.mapInArrow(encode, ddl + (", ids array<int>, decoded string" if with_ids else ""))

"""Per-worker caches of encoded words, for tokenizers that never merge across them.

Synthetic and natural text alike repeat most of their words.  A worker encodes
each distinct word with the tokenizers library once and answers the rest from
a dict.  The caches live in the worker process, hold a bounded number of
words, and hold nothing that can't be made again, so a lost executor costs
only the time to fill a new one.
"""
from __future__ import annotations

import ctypes
import gc
import json
import os
import sys
from array import array
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa

#: Words a worker remembers, and the longest that it remembers.
CACHE_WORDS, CACHE_CHARS = 500_000, 64
#: Characters given to the tokenizer at once: its encodings take many times that.
ENCODE_CHARS = 1 << 18
#: Words joined to one text for the tokenizer (64 characters each at most).
GROUP_WORDS = 1024

_tokenizers: dict[str, object] = {}
_edges: dict[str, tuple[bool, np.ndarray]] = {}


def tokenizer(path: str):
    """The tokenizers-library tokenizer at ``path``, loaded once per process."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def encode_all(path: str, words: list[str]):
    """Ids of each word, in groups of bounded size."""
    tok, i = tokenizer(path), 0
    while i < len(words):
        j, n = i, 0
        while j < len(words) and (j == i or n + len(words[j]) <= ENCODE_CHARS):
            n += len(words[j])
            j += 1
        for e in tok.encode_batch_fast(words[i:j], add_special_tokens=False):
            yield e.ids
        i = j


def edges(path: str) -> tuple[bool, np.ndarray]:
    """(last, which): which ids end a pre-token (by the model's suffix for that) or, without
    such a suffix (last is False), begin with a space; byte-level tokenizers write it as Ġ."""
    if path not in _edges:
        with open(path, encoding="utf-8") as f:
            suffix = json.load(f)["model"].get("end_of_word_suffix")
        vocab = tokenizer(path).get_vocab()
        which = np.zeros(max(vocab.values()) + 1, bool)
        ids = {t: i for t, i in vocab.items() if (t.endswith(suffix) if suffix else t[:1] == "Ġ")}
        if not suffix or sum(len(t) == 1 + len(suffix) for t in ids) >= 256:  # else a word's last byte may have no id
            which[list(ids.values())] = True
        _edges[path] = bool(suffix), which
    return _edges[path]


def encode_letters(path: str, words: list[str], glue: str):
    """(ids, ends) of groups of ``words``, each of letters behind one space at most, where ``glue``
    between them keeps each a pre-token of its own: a group is encoded as one text and cut by
    the :func:`edges` of pre-tokens.  Where these are not as many as the words (letters that the
    normalizer takes apart), its words are encoded one by one."""
    tok, (last, edge) = tokenizer(path), edges(path)
    for i in range(0, len(words), GROUP_WORDS):
        some = words[i:i + GROUP_WORDS]
        ids = np.array(tok.encode_batch_fast([glue.join(some)], add_special_tokens=False)[0].ids)
        at = np.flatnonzero(edge[ids])
        ends = at + 1 if last else np.append(at[1:], len(ids))
        if len(at) != len(some):
            one = list(encode_all(path, some))
            ids, ends = np.concatenate(one), np.cumsum([len(x) for x in one])
        yield ids, ends


class WordCache:
    """word -> value, where ``make`` turns a list of words into their values."""

    def __init__(self, make, fixed: dict | None = None, limit: int = CACHE_WORDS):
        self.make, self.fixed, self.limit = make, fixed or {}, limit
        self.known = dict(self.fixed)

    def values(self, words: list[str]) -> list:
        got = list(map(self.known.get, words))
        if None not in got:
            return got
        new = list(dict.fromkeys(w for w, v in zip(words, got) if v is None))
        made = dict(zip(new, self.make(new)))
        if len(self.known) + len(made) > self.limit + len(self.fixed):
            self.known = dict(self.fixed)
        self.known.update((w, v) for w, v in made.items() if len(w) <= CACHE_CHARS)
        return [made[w] if v is None else v for w, v in zip(words, got)]


class RecurringCache(WordCache):
    """A :class:`WordCache` for texts where most distinct words come once: ``limit``
    bounds all that it holds, half of it for words met once and half for words met again.
    Each half keeps its newest words, so a word that came once never drives out one that recurs."""

    def __init__(self, make, limit: int = CACHE_WORDS):
        self.make, self.limit = make, limit
        self.known, self.older, self.once, self.once_older = {}, {}, {}, {}

    def values(self, words: list[str]) -> list:
        got = list(map(self.known.get, words))
        if None not in got:
            return got
        more, new = {}, []
        for w in dict.fromkeys(w for w, v in zip(words, got) if v is None):
            v = self.older.pop(w, None) or self.once.pop(w, None) or self.once_older.pop(w, None)
            if v is None:
                new.append(w)
            else:
                more[w] = v
        made = dict(zip(new, self.make(new)))
        self.known, self.older = self._newest(self.known, self.older, more)
        self.once, self.once_older = self._newest(self.once, self.once_older, made)
        made.update(more)
        return [made[w] if v is None else v for w, v in zip(words, got)]

    def _newest(self, new: dict, old: dict, more: dict) -> tuple[dict, dict]:
        """The two generations of one half after ``more`` words; each holds a quarter of the limit."""
        room = self.limit // 4
        if len(new) + len(more) > room:
            new, old = {}, new
        new.update((w, more[w]) for w in islice((w for w in more if len(w) <= CACHE_CHARS), max(0, room - len(new))))
        return new, old


def packed_ids(path: str, width: int, glue: str | None = None):
    """A ``make`` for little-endian ids of ``width`` bytes each.  With ``glue``, words of letters
    are encoded together, with it between them (see :func:`encode_letters`)."""
    pack, little = {1: "B", 2: "H", 4: "I", 8: "Q"}[width], sys.byteorder == "little"

    def packed(ids):
        ids = array(pack, ids)
        if not little:
            ids.byteswap()
        return ids.tobytes()

    def make(words):
        plain = [glue is not None and len(w) <= CACHE_CHARS and w.isalpha() for w in words]
        rest = map(packed, encode_all(path, [w for w, p in zip(words, plain) if not p]))
        joined = encode_letters(path, [w for w, p in zip(words, plain) if p], glue)
        joined = ((ids.astype(f"<u{width}").tobytes(), ends) for ids, ends in joined)
        cut = (ids[a:b] for ids, ends in joined for a, b in pairwise([0, *(width * ends).tolist()]))
        return (next(cut) if p else next(rest) for p in plain)
    return make


def token_numbers(path: str, words: list[str]):
    """How many ids each of ``words`` has, for a byte-level tokenizer that begins a pre-token at
    a space before letters: such words are encoded together (see :func:`encode_letters`)."""
    plain = [len(w) <= CACHE_CHARS and w[:1] == " " and w[1:].isalpha() for w in words]
    rest = map(len, encode_all(path, [w for w, p in zip(words, plain) if not p]))
    cut = (n for _, ends in encode_letters(path, [w for w, p in zip(words, plain) if p], "") for n in np.diff(ends, prepend=0).tolist())
    return (next(cut) if p else next(rest) for p in plain)


_caches: dict[tuple, WordCache] = {}


def worker_cache(key: tuple, build) -> WordCache:
    """The worker's cache under ``key``, built by ``build()`` where there is none.
    Only the last is kept: workers outlive their queries, and the memory of another
    one's cache goes back to the system first.  (Called by name, so that tasks find
    the caches of this module and not a pickled copy.)"""
    if key not in _caches:
        if _caches:
            _caches.clear()
            give_back()
        _caches[key] = build()
    return _caches[key]


def give_back() -> None:
    """Return freed memory to the system, which the allocators keep otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass

"""Texts cut into chunks that no tokenizer merges across, coded by Arrow.

A single space between two characters that are no white space always starts a
new pre-token of a byte-level BPE, and no piece of a piece model has a marker
behind another character.  So texts are cut before such spaces, and a batch's
chunks become codes into the list of its distinct ones.  What is done once for
a distinct chunk (encoding, aligning) is then gathered by code.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def chunked(texts: pa.Array, lead: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(starts, codes, chunks): text i is the join of ``chunks[c]`` for c in
    ``codes[starts[i]:starts[i + 1]]``.  With ``lead``, a space goes before each
    text.  A NULL or empty text has no chunk unless ``lead`` gives it its space.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.split_pattern(texts, " ")
    starts = np.asarray(parts.offsets).astype(np.int64)
    starts, values = starts - starts[0], parts.flatten()
    if len(values) == 0:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), []
    coded = values.dictionary_encode()
    codes, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
    begins = np.array([w != "" and not w[0].isspace() for w in words], bool)
    ends = np.array([w != "" and not w[-1].isspace() for w in words], bool)
    # a part opens a chunk where the space before it may be cut
    opens = np.concatenate([[True], ends[codes[:-1]] & begins[codes[1:]]])
    first = np.zeros(len(codes), bool)
    first[starts[:-1][starts[:-1] < starts[1:]]] = True
    opens |= first
    at = np.flatnonzero(opens)
    width = np.diff(np.append(at, len(codes)))
    # a chunk of one part is known by its word and by whether it begins a text
    keys, seen = 2 * codes[at] + first[at], np.zeros(2 * len(words), bool)
    seen[keys[width == 1]] = True
    code = (np.cumsum(seen) - 1)[keys]
    head = ("", " ")[lead]
    chunks = [(head if k & 1 else " ") + words[k >> 1] for k in np.flatnonzero(seen).tolist()]
    if (width > 1).any():
        known: dict[str, int] = {}
        for j in np.flatnonzero(width > 1).tolist():
            joined = " ".join([words[c] for c in codes[at[j]:at[j] + width[j]].tolist()])
            joined = (head if first[at[j]] else " ") + joined
            k = known.get(joined)
            if k is None:
                k = known[joined] = len(chunks)
                chunks.append(joined)
            code[j] = k
    starts = np.searchsorted(at, starts)
    if "" in chunks:  # an empty text
        keep = code != chunks.index("")
        starts, code = np.concatenate([[0], np.cumsum(keep)])[starts], code[keep]
    return starts, code, chunks


def gathered(values: list[bytes] | pa.Array, codes: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The join of ``values[c]`` for c in ``codes``, and where each begins (one more at the end)."""
    if len(codes) == 0:
        return memoryview(b""), np.zeros(1, np.int64)
    taken = (values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())).take(pa.array(codes))
    return memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64, len(codes) + 1)

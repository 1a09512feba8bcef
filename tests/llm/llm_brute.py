"""Plain Python versions of the training-data operators."""
import hashlib
import re
from collections import Counter
from math import inf

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_components(texts):
    """(set size, smallest linked index) of each text."""
    sets, label = [shingle_set(t) for t in texts], list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and 100 * o >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(len(a), root(i)) for i, a in enumerate(sets)]


def repeated_bytes(texts):
    where, raw = {}, [(t or "").encode() for t in texts]
    for i, b in enumerate(raw):
        for p in range(len(b) - 199):
            where.setdefault(b[p:p + 200], []).append((i, p))
    cover = [np.zeros(len(b), bool) for b in raw]
    for places in where.values():
        if len(places) > 1:
            for i, p in places:
                cover[i][p:p + 200] = True
    return [(len(b), int(c.sum()), int((np.diff(np.concatenate([[0], c.astype(int)])) == 1).sum()),
             hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~c])).hexdigest()) for b, c in zip(raw, cover)]


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def best_segmentation(pieces, data, unknown):
    """Highest score over every cut of ``data`` (bytes), piece by piece."""
    best = [0.0] + [-inf] * len(data)
    for i in range(len(data)):
        if best[i] == -inf:
            continue
        n = 1 + (data[i] >= 0xC0) + (data[i] >= 0xE0) + (data[i] >= 0xF0)
        for j in range(i + 1, len(data) + 1):
            s = pieces.get(data[i:j], unknown if j == i + n else None)
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]

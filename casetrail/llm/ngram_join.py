"""N-gram Jaccard join: subsets for small sets, inverted lists for large ones.

A document's set holds the 64-bit hashes of its distinct 5-word shingles; two
documents link at a Jaccard similarity of 0.8 or more.

1. Documents with equal sets become one class, whose smallest id stands for it
   (map-side first, so copies without number cost one row per task).
2. Small sets, of at most ``boundary`` shingles, enumerate all subsets that may
   be their overlap with a partner.  Two sets that share a subset of k shingles
   link if k >= 0.8 (n + m - k); with the smallest set of a subset's list as its
   partner, every other set of the list is linked that any of them is linked to.
3. Large sets post their prefixes to inverted lists, their rarest shingles: in any
   one order of all shingles, a pair with the needed overlap meets in the first
   floor(n/9)+1 of the smaller and the first floor(m/5)+1 of the larger.  The
   order is by how often the corpus has shingles of the same slot of a table of
   fixed size (counted over all texts first, and broadcast), then by hash, so
   passages that many documents share fall out of the prefixes.  Every list is scanned against one
   of its sets, sizes and parity sketches rule out most pairs, the others are
   compared exactly, and components are formed.
4. Lists that still hold several components are made again and scanned whole,
   across components only.  Short ("light") ones pair directly.  Documents in
   long ("heavy") ones, whose slots told too little, are joined anew in the order of
   how many of these documents hold a shingle.

Prefixes are stored once.  The lists are made from them in ``PARTS`` parts, by
key, one part after the other: a part's pairs are stored before the next begins,
so that no more than a part of all list entries is on disk at a time.

The boundary is the size at which the subsets of the small sets cost more rows
than list entries and their scans, by the sizes and list lengths of this input.
No pair is dropped: all filters are exact bounds.

Defined results: a NULL, empty or wordless text has the empty set, which links
with nothing; fewer than five words make one shingle; rows with the same
doc_id are one document for links; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import run_dir, small_batches, store
from .components import components

N = 5
#: Largest size that may count as small, and the sizes at which the boundary may lie.
SMALL, BOUNDARIES = 24, (0, 4, 9, 14, 19, 24)
#: Entries of a list from which it is heavy.
HEAVY = 64
#: Parts of the lists, and of the pairs whose texts are compared, that are worked on one by one.
PARTS, TEXT_PARTS = 4, 2
#: Subsets that a task holds.
SUBSET_ROWS = 20_000
#: Sets that one task compares with one text's.
PARTNERS = 1024

_upper = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(p: int) -> np.ndarray:
    out = np.full(BLOCK + LONG_WORD, p, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Bytes hashed at once, and the length from which a word is hashed by itself.
BLOCK, LONG_WORD = 1 << 14, 64
_PRIME = 0xD1342543DE82EF95
_UP, _DOWN = _powers(_PRIME), _powers(pow(_PRIME, -1, 1 << 64))
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_PLACE = _mix(np.arange(257, 257 + N, dtype=np.uint64) * _ODD) | np.uint64(1)  # a word's factor by its place in a shingle
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased bytes: differences of a prefix
    sum of byte values times powers, shifted to the word's start."""
    b = np.frombuffer(data, np.uint8)
    edge = np.diff((~_SPACE[b]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.zeros(len(start), np.uint64)
    for at in range(0, len(b), BLOCK):  # words that start in this block and are not long
        i, j = np.searchsorted(start, [at, at + BLOCK])
        total = np.zeros(min(BLOCK + LONG_WORD, len(b) - at) + 1, np.uint64)
        np.cumsum(_BYTE[b[at:at + BLOCK + LONG_WORD]] * _UP[:len(total) - 1], out=total[1:])
        out[i:j] = (total[np.minimum(end[i:j] - at, len(total) - 1)] - total[start[i:j] - at]) * _DOWN[start[i:j] - at]
    for k in np.flatnonzero(end - start > LONG_WORD):
        out[k] = xxhash.xxh64_intdigest(data[start[k]:end[k]])
    return out


def shingles(text: str | None, distinct: bool = True) -> np.ndarray:
    """The set of a text: distinct 64-bit shingle hashes, ascending (or as they come)."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass").translate(_upper))
    if not len(w):
        return np.zeros(0, np.uint64)
    n = max(1, len(w) - N + 1)
    w = _mix(w)
    h = np.full(n, min(len(w), N), np.uint64)
    for k in range(min(N, len(w))):
        h += w[k:k + n] * _PLACE[k]
    if not distinct:
        return _mix(h)
    h = np.sort(_mix(h))
    return h[np.append(True, h[1:] != h[:-1])]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    o = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * o >= 80 * (len(a) + len(b) - o) and o > 0


#: Most bits of a sketch.
SKETCH = 1 << 20


def sketch(s: np.ndarray) -> bytes:
    """One bit for each value of the low hash bits: whether an odd number of the
    set's shingles have it.  About as many bits as shingles."""
    m = min(max(64, 1 << (len(s) - 1).bit_length()), SKETCH) if len(s) else 64
    odd = np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(a: bytes, n: int, b: bytes, m: int) -> bool:
    """False only where the sketches prove that sets of n and m don't link: each
    bit that differs takes a shingle of one set only, and linked sets have at
    most (n + m) / 9 of these.  A longer sketch folds onto a shorter one."""
    if 9 * abs(n - m) > n + m:
        return False
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):
        a = np.bitwise_xor.reduce(np.frombuffer(a, np.uint8).reshape(-1, len(b)), axis=0).tobytes()
    return 9 * (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() <= n + m


#: Slots of the table of how often shingles occur: 4 MB, whatever the corpus.
SLOT_BITS = 20


def slots(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def shingle_counts(docs: DataFrame, text_col: str = "text", fan_in: int = 16) -> np.ndarray:
    """How many shingles of the corpus fall into each slot (repeats in a text count;
    the table only steers the order).  One compressed table a task, added up ``fan_in`` at a time."""
    def row(counts):
        return pa.RecordBatch.from_arrays([pa.array([zlib.compress(counts.astype("<u4").tobytes(), 1)], pa.binary())], names=["counts"])

    def count(batches):
        total = np.zeros(1 << SLOT_BITS, np.uint64)
        for b in small_batches(batches):
            some = [slots(shingles(t, distinct=False)) for t in b.column(0).to_pylist()]
            total += np.bincount(np.concatenate(some), minlength=len(total)).astype(np.uint64)
        yield row(np.minimum(total, 0xFFFFFFFF))

    def add(batches):
        total = np.zeros(1 << SLOT_BITS, np.uint64)
        for b in batches:
            for c in b.column(0):
                total += np.frombuffer(zlib.decompress(c.as_py()), "<u4")
        yield row(np.minimum(total, 0xFFFFFFFF))

    texts = docs.select(F.col(text_col).alias("text"))
    tables, n = texts.mapInArrow(count, "counts binary"), texts.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // fan_in)
        tables = tables.repartition(n).mapInArrow(add, "counts binary")
    rows = tables.collect()  # one table
    return np.frombuffer(zlib.decompress(rows[0][0]), "<u4") if rows else np.zeros(1 << SLOT_BITS, "<u4")


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def document_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid (a number of the row), doc_id, n, sig (128 bits of the whole set), first: the
    rarest hashes of the set, as many as its prefix needs, or all of a small set; bits: its sketch."""
    table = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, text_col))
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))

    def run(batches):
        uid = TaskContext.get().partitionId() << 33
        for b in small_batches(batches):
            sets = [shingles(t) for t in b.column(0).to_pylist()]
            uids, uid = range(uid, uid + len(sets)), uid + len(sets)
            # equal counts keep the order of the hashes
            first = [_signed(s[np.argsort(table.value[slots(s)], kind="stable")[:len(s) if len(s) <= SMALL else len(s) // 5 + 1]])
                     for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), b.column(1), pa.array([len(s) for s in sets], pa.int32()),
                 pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                 pa.array(first, pa.list_(pa.int64())), pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())],
                names=["uid", "doc_id", "n", "sig", "first", "bits"])

    return rows.mapInArrow(run, "uid long, doc_id long, n int, sig binary, first array<long>, bits binary")


def subset_cost(n: int) -> int:
    return sum(comb(n, d) for d in range(n // 5 + 1))


def choose_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The boundary with the fewest rows: sets by size, and the mean list length."""
    listed = lambda n: (n // 5 + 1) * (1 + list_length)

    def rows(x):
        return sum(c * ((subset_cost(n) if n <= x else 0) + (listed(n) if 5 * n > 4 * x else 0)) for n, c in sizes.items())
    return min(BOUNDARIES, key=lambda x: (rows(x), x))


def _subsets(boundary: int):
    """Small sets -> (k, key, n, rid) for every subset that may be an overlap."""
    from itertools import combinations

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.int64()))],
                                          names=["k", "key", "n", "rid"])

    def run(batches):
        out: list[tuple] = []
        for b in batches:
            for rid, n, first in zip(*(b.column(i).to_pylist() for i in range(3))):
                h = _mix(np.array(first, np.int64).view(np.uint64))
                for gone in (g for d in range(n // 5 + 1) for g in combinations(range(n), d)):
                    kept = np.delete(h, list(gone))
                    out.append((len(kept), int(_mix(kept.sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]), n, rid))
                if len(out) >= SUBSET_ROWS:
                    yield rows(out)
                    out = []
        if out:
            yield rows(out)
    return run


def _compare(batches):
    """Rows sorted by (target, salt), the target's own text first -> the linked pairs."""
    at, heads = None, []
    for b in small_batches(batches):
        hit = []
        for v, salt, u, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (v, salt) != at:
                at, heads = (v, salt), []
            mine = shingles(text)
            if u is None:  # rows with one id may hold several texts
                heads.append(mine)
            elif any(linked(mine, h) for h in heads):
                hit.append((u, v))
        yield pa.RecordBatch.from_pydict({"u": [u for u, _ in hit], "v": [v for _, v in hit]},
                                         schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def _possible(batches):
    """(u, v, n and sketch of u, n and sketch of v) -> the pairs that may link."""
    for b in batches:
        u, v, nu, bu, nv, bv = (b.column(i).to_pylist() for i in range(6))
        hit = [i for i in range(len(u)) if may_link(bu[i], nu[i], bv[i], nv[i])]
        yield pa.RecordBatch.from_pydict({"u": [u[i] for i in hit], "v": [v[i] for i in hit]},
                                         schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """The pairs (u, v) whose texts link.  Sizes and sketches go first; only the
    texts of the pairs that they leave are brought together: u's to v's, where each
    task takes up to ``PARTNERS`` of v's partners (by expectation)."""
    a, b = (classes.select(F.col("rid").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}")) for x in "uv")
    pairs = pairs.distinct().join(b, "v").join(a, "u").filter("9 * abs(nu - nv) <= nu + nv").select("u", "v", "nu", "bu", "nv", "bv")
    pairs = store(pairs.mapInArrow(_possible, "u long, v long").distinct(), f"{path}-pairs")
    salts = pairs.groupBy("v").agg((F.floor(F.count(F.lit(1)) / PARTNERS) + 1).cast("int").alias("salts"))
    meet = pairs.join(salts, "v").select(F.col("u").alias("rid"), "v", F.pmod(F.xxhash64("u"), "salts").cast("int").alias("salt"),
                                         F.col("u").alias("who"))
    own = salts.select(F.col("v").alias("rid"), "v", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                       F.lit(None).cast("long").alias("who"))
    meet = store(meet.unionByName(own), f"{path}-meet")
    found = []
    for k in range(TEXT_PARTS):
        part = texts.join(meet.filter(F.pmod(F.xxhash64("v"), F.lit(TEXT_PARTS)) == k), "rid").select("v", "salt", "who", "text")
        rows = part.repartition("v", "salt").sortWithinPartitions("v", "salt", F.col("who").asc_nulls_first())
        found.append(store(rows.mapInArrow(_compare, "u long, v long"), f"{path}-links-{k}"))
    return reduce(DataFrame.unionByName, found).distinct()


def _posted(sets: DataFrame, classes: DataFrame, least: int, part: int | None = None, parts: int = PARTS) -> DataFrame:
    """The list entries of sets of more than ``least`` shingles (of one part of
    the keys): key, indexed, and the columns of ``classes``.  Keys are dealt to
    parts before the arrays meet their classes, so a part's entries alone move."""
    prefix = F.transform(F.slice("first", 1, F.floor(F.col("n") / 5).cast("int") + 1),
                         lambda x, i: F.struct(x.alias("key"), (i <= F.floor(F.col("n") / 9)).alias("indexed")))
    if part is not None:
        prefix = F.filter(prefix, lambda x: F.pmod(x["key"], F.lit(parts)) == part)
    rows = sets.filter(F.col("n") > least).select("uid", prefix.alias("keys")).filter(F.size("keys") > 0)
    # one plan at all sizes: a small table of classes isn't broadcast
    return rows.join(classes.hint("merge"), "uid").select(*[c for c in classes.columns if c not in ("uid", "bits")], F.inline("keys"))


def _across(lists: DataFrame) -> DataFrame:
    """Pairs of different components within each list: an indexed set and a
    probing one that is not smaller, of sizes that can link."""
    x = lists.filter("indexed").select("key", F.col("rid").alias("v"), F.col("n").alias("nv"), F.col("component").alias("cv"))
    y = lists.select("key", F.col("rid").alias("u"), F.col("n").alias("nu"), F.col("component").alias("cu"))
    j = x.join(y, (x["key"] == y["key"]) & (F.col("cv") != F.col("cu")) & (5 * F.col("nv") >= 4 * F.col("nu"))
               & ((F.col("nv") < F.col("nu")) | ((F.col("nv") == F.col("nu")) & (F.col("v") < F.col("u")))))
    return j.select("u", "v").distinct()


def set_links(sets: DataFrame, classes: DataFrame, texts: DataFrame, path: str, heavy: int = HEAVY) -> DataFrame:
    """(node, component) of the classes that link with another.  ``sets``: uid,
    n, first; ``classes``: uid, rid, n, bits; ``texts``: rid, text."""
    small = classes.filter(F.col("n") <= SMALL)
    posted = _posted(sets.filter(F.col("n") <= SMALL), small, 0)
    per_list = posted.groupBy("key").agg(F.count(F.lit(1)).alias("c")).agg(F.avg("c")).first()[0] or 0.0
    boundary = choose_boundary({r["n"]: r["count"] for r in small.groupBy("n").count().collect()}, per_list)

    subsets = (sets.filter(F.col("n") <= boundary).select("uid", "first").join(classes.select("uid", "rid", "n"), "uid")
               .select("rid", "n", "first").mapInArrow(_subsets(boundary), "k int, key long, n int, rid long"))
    least = subsets.groupBy("k", "key").agg(F.min(F.struct("n", "rid")).alias("low"))
    near = subsets.join(least, ["k", "key"]).filter("rid <> low.rid and 100 * k >= 80 * (n + low.n - k)")
    edges = store(near.select(F.col("rid").alias("u"), F.col("low.rid").alias("v")).distinct(), f"{path}/small")

    # large sets, and the small ones that a large one may be linked to: 5 n > 4 boundary
    above = 4 * boundary // 5
    pairs = []
    for k in range(PARTS):
        post = _posted(sets, classes.select("uid", "rid"), above, k)
        heads = (post.groupBy("key").agg(F.min(F.when(F.col("indexed"), F.col("rid"))).alias("head"), F.count(F.lit(1)).alias("c"))
                 .filter("c > 1 and head is not null").drop("c"))
        shared = post.join(heads, "key").filter("rid <> head")
        pairs.append(store(shared.select(F.col("rid").alias("u"), F.col("head").alias("v")).distinct(), f"{path}/heads-{k}"))
    edges = edges.unionByName(_verified(reduce(DataFrame.unionByName, pairs), classes, texts, f"{path}/heads"))

    # heads were compared with all of their lists; what is left is between the others
    label = components(edges)
    known = classes.select("uid", "rid", "n").join(label.withColumnRenamed("node", "rid"), "rid", "left")
    known = store(known.withColumn("component", F.coalesce("component", "rid")), f"{path}/known")
    lists = []
    for k in range(PARTS):
        post = _posted(sets, known, above, k)
        many = (post.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("c"),
                                        F.min(F.when(F.col("indexed"), F.col("rid"))).alias("head"))
                .filter("a <> b and head is not null").select("key", "head", (F.col("c") > heavy).alias("heavy")))
        lists.append(store(post.join(many, "key").filter("rid <> head").drop("head"), f"{path}/lists-{k}"))
    lists = reduce(DataFrame.unionByName, lists)
    more = _across(lists.filter("not heavy"))
    again = store(lists.filter("heavy").select("rid", "n", "component").distinct(), f"{path}/heavy")
    if not again.isEmpty():
        more = more.unionByName(_rarest_first(again, texts, path))
    found = _verified(more, classes, texts, f"{path}/rest")
    return components(edges.unionByName(found))


def _rarest_first(again: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """Candidate pairs among the documents of heavy lists, by prefixes in the
    order of how many of these documents have a shingle, the rarest first."""
    def explode(batches):
        for b in small_batches(batches, 1 << 20):
            rid, text = (b.column(i).to_pylist() for i in range(2))
            sets = [shingles(t) for t in text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(rid, np.int64), [len(s) for s in sets])), pa.array(_signed(np.concatenate(sets)))],
                names=["rid", "key"])

    ids = again.select("rid").distinct()
    rows = store(texts.join(ids, "rid", "left_semi").select("rid", "text").mapInArrow(explode, "rid long, key long"), f"{path}/shingles")
    # shingles of one document only can't be shared: they need no list and come first
    df = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    often = rows.join(df, "key").groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("df", "key"))).alias("keys")).join(again, "rid")
    # of the first floor(n/5)+1 shingles, n - size(keys) are its own
    own = F.col("n") - F.size("keys")
    taken = lambda part: F.greatest(F.floor(F.col("n") / part).cast("int") + 1 - own, F.lit(0))
    lists = often.select("rid", "component", "n", taken(9).alias("at9"), F.posexplode(F.slice("keys", 1, taken(5))).alias("at", "k"))
    lists = store(lists.select(F.col("k.key").alias("key"), "rid", "component", "n", (F.col("at") < F.col("at9")).alias("indexed")),
                  f"{path}/rare")
    return _across(lists)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_shingles, component_id (and the class: the smallest id with the same set)."""
    path = run_dir(docs.sparkSession, "ngram-join")
    sets = store(document_sets(docs, id_col, text_col), f"{path}/sets")
    # the smallest id of an equal set stands for it, with one of its rows
    classes = sets.filter("n > 0 and doc_id is not null").groupBy("sig", "n").agg(F.min(F.struct("doc_id", "uid")).alias("one"))
    classes = store(classes.select("sig", "n", F.col("one.doc_id").alias("rid"), F.col("one.uid").alias("uid")), f"{path}/classes")
    sketched = store(classes.select("uid", "rid", "n").join(sets.select("uid", "bits"), "uid"), f"{path}/sketches")
    # of several rows with a class's id any has the same set, unless ids repeat; then all sets of an id are compared
    texts = docs.select(F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"))
    links = set_links(sets.select("uid", "n", "first"), sketched, texts, path, heavy)
    member = sets.select("doc_id", "n", "sig").join(classes.select("sig", "rid"), ["sig"], "left")
    out = member.join(links, F.col("rid") == links["node"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.coalesce("component", "rid", "doc_id").alias("component_id"), F.coalesce("rid", "doc_id").alias("class_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the smallest id."""
    gone = near_copies(docs, id_col, text_col).filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")

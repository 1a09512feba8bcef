"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives.  The unlabelled text is drawn from
all documents of the training folds, whatever their labels, so that a share
``prior`` of it is toxic, as estimated from the positives and the unlabelled
text (see ``class_prior``), so that labels need not cover a random part.  The classifiers are linear over
hashed words (present or not) and word stems: a stem is the first 4 or 6 letters
of a longer word, and counts as present, as shared by 2 or by 3 distinct words of the
text, and as shared by a 128th, 64th or 32nd of them.  So rare forms of a word
share their evidence, and one form by chance in a long text is told from many.
They minimise the risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss: the negative part, an estimate that sampling can push
below zero, is held at zero, and its gradient turned round while it is below.
The classifiers are numpy arrays, fitted on the driver on a bounded sample (see
``MAX_POSITIVE`` and ``MAX_UNLABELLED``; rows in the order of a hash, the same
in every run), and broadcast: 4 bytes * ``FEATURES`` each, whatever the corpus.
Every whole text is then scored on the map side.

Labels are learnt only from rows whose crc32(doc_id as text) mod ``FOLDS`` is
not 0; labels, lang, source and doc_id are no inputs of a score.

Defined results: a NULL or empty text has no words and the score of the bias;
without any positive, the score is ``prior`` (0 if there are no labels) for
all; NULL labels are no label; of several labels of a document the largest
counts; a NULL doc_id is never trained on; repeated rows get equal scores; an
empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .word_cache import WordCache, give_back, worker_cache

FEATURES, FOLDS, CLASSIFIERS = 1 << 21, 5, 3
MAX_POSITIVE, MAX_UNLABELLED = 3000, 12000
STEPS, RATE, DECAY = 200, 0.1, 1e-4
MIN_DOCS, MIN_Z, MIN_FEATURES = 3, 6.0, 4
#: The part of the positives whose scores may tell the class prior.
LEAST_OVER = 0.25
#: Words that the driver remembers while it reads its sample.
DRIVER_WORDS = 50_000
#: Letters of a stem, distinct words that share it, and the part of a text's distinct words that they are.
STEMS, SHARED, PARTS = (4, 6), (2, 3), (128, 64, 32)

_word = re.compile(r"\w+")


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _hash(words):
    """Per word the hashes of it and of its stems, 4 bytes each."""
    for w in words:
        stems = [zlib.crc32(w[:n].encode("utf-8", "replace"), n) for n in STEMS if len(w) > n]
        yield struct.pack(f"<{1 + len(stems)}I", zlib.crc32(w.encode("utf-8", "replace")), *stems)


def features(text: str, cache: WordCache) -> np.ndarray:
    """The features of a text: its words and stems, and the levels of shared stems."""
    words = list(set(_word.findall(text.lower())))
    found, n = np.unique(np.frombuffer(b"".join(cache.values(words)), "<u4"), return_counts=True)
    shared, m = found[n > 1].astype(np.int64), n[n > 1]
    levels = [shared[m >= k] * (2 * k + 1) + k for k in SHARED]
    levels += [shared[m * k >= len(words)] * (2 * k + 1) + k for k in PARTS]
    return (np.concatenate([found.astype(np.int64), *levels]) % FEATURES).astype(np.int32)


class Sparse:
    """Documents as one run of feature numbers and their starts."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.col = np.concatenate(rows) if rows else np.zeros(0, np.int64)

    def score(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.n) + bias

    def back(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.col, weights=g[self.row], minlength=size)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_nnpu(positive: Sparse, unlabelled: Sparse, prior: float, size: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier, by Adam on the non-negative risk."""
    x = np.zeros(size + 1)  # the bias is the last
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    x[size] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        sp, su = positive.score(x[:size], x[size]), unlabelled.score(x[:size], x[size])
        # logistic loss: l+(s) = log(1 + e^-s), l-(s) = log(1 + e^s)
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        gp, gu = prior * (_sigmoid(sp) - 1) / positive.n, np.zeros(unlabelled.n)
        if negative >= 0:
            gp, gu = gp - prior * _sigmoid(sp) / positive.n, _sigmoid(su) / unlabelled.n
        else:  # climb out of the over-fitted negative part
            gp, gu = prior * _sigmoid(sp) / positive.n, -_sigmoid(su) / unlabelled.n
        g = np.append(positive.back(gp, size) + unlabelled.back(gu, size), gp.sum() + gu.sum())
        g[:size] += DECAY * x[:size]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:size].astype(np.float32), float(x[size])


def training_sample(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text",
                    max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED):
    """(positives, unlabelled, prior) of the training folds.  A row of the first two
    is the features of a text: a text is let go before the next one comes."""
    lab = (labels.filter((remainder(F.col("doc_id")) != 0) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic")))
    n, toxic = lab.agg(F.count(F.lit(1)), F.sum("_toxic")).first()
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.filter((remainder(F.col("_id")) != 0) & F.col("_id").isNotNull())
    order = F.xxhash64(F.lit("nnpu"), "_id")
    # the ids are chosen by narrow rows; only the chosen texts are fetched
    ids = (lab.filter("_toxic = 1").select("_id").join(d.select("_id").distinct(), "_id", "left_semi")
           .orderBy(order, "_id").limit(max_positive).withColumn("_kind", F.lit(1)))
    some = (d.select("_id").distinct().orderBy(order, "_id").limit(max_unlabelled).withColumn("_kind", F.lit(0)))
    chosen = F.broadcast(ids.unionByName(some))  # at most max_positive + max_unlabelled rows
    texts = d.join(chosen, "_id").select("_kind", "_id", "_text").dropDuplicates(["_kind", "_id"])
    cache, rows = WordCache(_hash, limit=DRIVER_WORDS), {}
    for r in texts.toLocalIterator():
        rows[r["_kind"], r["_id"]] = features(r["_text"], cache)
    pos, unl = ([rows[k] for k in sorted(rows) if k[0] == kind] for kind in (1, 0))
    return pos, unl, (toxic or 0) / n if n else 0.0


def _counts(rows: list[np.ndarray], size: int, some: int = 500) -> np.ndarray:
    """How many rows hold each feature, added up by groups to bound the memory."""
    return sum((np.bincount(np.concatenate(rows[i:i + some]), minlength=size) for i in range(0, len(rows), some)),
               np.zeros(size, np.int64))


def narrowed(pos: list[np.ndarray], unl: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(used, positives, unlabelled): the features that ``MIN_DOCS`` rows hold, and the rows
    by their numbers among these.  All others, which tell nothing, get the number after the last."""
    used = np.flatnonzero(_counts(pos, FEATURES) + _counts(unl, FEATURES) >= MIN_DOCS)
    number = np.full(FEATURES, len(used), np.int32)
    number[used] = np.arange(len(used))
    return used, [number[r] for r in pos], [number[r] for r in unl]


def telling(pos: list[np.ndarray], unl: list[np.ndarray], size: int) -> np.ndarray:
    """Which of ``size`` features differ between the two sets by ``MIN_Z`` standard errors,
    or are among the ``MIN_FEATURES`` that differ most: rare words would only let
    the classifier learn its positives by heart.  The last number stands for rare ones."""
    p, u = _counts(pos, size + 1), _counts(unl, size + 1)
    p[size] = u[size] = 0
    n, m = len(pos), len(unl)
    both = np.minimum((p + u) / (n + m), 1)
    z = np.abs(p / n - u / m) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n + 1 / m))
    z[p + u < MIN_DOCS] = 0.0
    return (z >= max(1e-9, min(MIN_Z, np.sort(np.append(z, np.zeros(MIN_FEATURES)))[-MIN_FEATURES])))


def class_prior(pos: list[np.ndarray], unl: list[np.ndarray], part: list[np.ndarray], size: int) -> float:
    """The toxic share of the unlabelled, by the best bin of scores: the share of
    the unlabelled over a score to that of the positives, one standard error up,
    where this bound is the lowest.  Only scores that a part ``LEAST_OVER`` of the
    positives exceeds count: higher up, a few near copies of one positive, of which
    no more are among the unlabelled, would pass for all.  Log odds of the telling
    features score; no document scores itself, nor does a copy of it (``part`` has
    the folds of both sets, equal for copies).  1 if the features tell nothing."""
    scores: list[list[float]] = [[], []]
    for k in range(FOLDS):
        p, u = ([r for r, f in zip(rows, of) if f != k] for rows, of in zip((pos, unl), part))
        if not p or not u:
            continue
        a, b = _counts(p, size + 1), _counts(u, size + 1)
        odds = np.where(telling(p, u, size), np.log((a + 1) / (len(p) + 2)) - np.log((b + 1) / (len(u) + 2)), 0.0)
        for to, rows, of in zip(scores, (pos, unl), part):
            to += [odds[r].sum() for r, f in zip(rows, of) if f == k]
    p, u = (np.sort(x) for x in scores)
    if not len(p) or not len(u):
        return 1.0
    over = lambda x: 1 - np.searchsorted(x, p) / len(x)
    a, b = over(p), np.maximum(over(u), 1 / len(u))
    error = np.sqrt((1 - a) / (a * len(p)) + (1 - b) / (b * len(u)))
    return float(min(1.0, (b / a * (1 + error))[a >= LEAST_OVER].min()))


def train(docs: DataFrame, labels: DataFrame, classifiers: int = CLASSIFIERS, **columns) -> tuple[np.ndarray, float, float]:
    """Mean weights and bias of the classifiers, and the class prior."""
    try:
        return _trained(*training_sample(docs, labels, **columns), classifiers)
    finally:
        give_back()


def _trained(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, classifiers: int) -> tuple[np.ndarray, float, float]:
    if not pos or not unl:
        return np.zeros(FEATURES, np.float32), float("nan"), prior
    part = [np.array([zlib.crc32(r.tobytes()) % FOLDS for r in rows]) for rows in (pos, unl)]
    used, pos, unl = narrowed(pos, unl)
    found = class_prior(pos, unl, part, len(used))
    # where the positives can't be told from the rest: the share among the labelled
    prior = min(max(found if found <= 0.5 else prior, 1e-3), 0.5)
    known = telling(pos, unl, len(used))
    column = np.cumsum(known) - 1
    dense = lambda rows: [column[r[known[r]]] for r in rows]
    pos, unl, size = dense(pos), dense(unl), int(known.sum())
    weights, bias = np.zeros(FEATURES), 0.0
    for k in range(classifiers):
        some = np.random.default_rng(k)
        u = [unl[i] for i in some.permutation(len(unl))[:max(1, len(unl) * 2 // 3)]]
        w, b = fit_nnpu(Sparse(pos), Sparse(u), prior, size)
        weights[used[known[:-1]]] += w / classifiers
        bias += b / classifiers
    return weights.astype(np.float32), bias, prior


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted; one row per document."""
    weights, bias, prior = train(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    scored = rows.mapInArrow(_scorer(docs, weights, bias, prior, 0, ["doc_id"]), "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _scorer(docs, weights, bias, prior, text_at, keep, score_name="score"):
    """A map over batches with the text at ``text_at`` that gives (*keep, score)."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = sent.value
        cache = worker_cache(("toxicity",), lambda: WordCache(_hash))
        for b in small_batches(batches):
            s = [w[features(t or "", cache)].sum(dtype=np.float64) + bias for t in b.column(text_at).to_pylist()]
            s = np.full(len(s), prior) if np.isnan(bias) else _sigmoid(np.array(s, float))
            kept = b.columns[b.num_columns - len(keep):]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(s)], names=[*keep, score_name])
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    weights, bias, prior = train(docs, labels, id_col=id_col, text_col=text_col)
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())  # each text goes to the workers once
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = docs.mapInArrow(_scorer(docs, weights, bias, prior, text_at, docs.columns, "__tox_score"), f"{schema}, `__tox_score` double")
    return scored.filter("`__tox_score` < 0.5").drop("__tox_score")

"""Personal data (native): candidate spans, boosted trees, calibrated thresholds.

High-recall generators propose spans that may overlap: the four base patterns,
whose valid matches are always redacted, and looser patterns around them (any
word with an at sign, any run of digits and separators).  Each candidate gets
format features (digits, separators, length, Luhn) and context features (the
characters and words beside it).  The loose candidates that a base pattern
confirms are positives, shown without what confirmed them: the '+' of a phone
is hidden.  So are numbers after a word for a phone.  The negatives are those that other evidence speaks against: runs
inside hex, code, dates, amounts or addresses, and e-mails without a domain.  The
rest (numbers without '+', e-mails in other letters) is open: not learnt from, and
added where it scores like the confirmed ones, as hinted numbers are; ip and card
have no such rest, as their validity settles them.  The labelled candidates are summed up by their features
(a table bounded by the number of feature values, made map-side first); a small
gradient-boosted ensemble of depth-two trees is fitted on it, and each kind's
threshold is the lowest score at which the held-out candidates reach
``PRECISION``.  The trees are then a sum of CASE expressions over each text's
candidates.  Everything that touches a text is a built-in column function, and
no row is shuffled but the feature sums.

Offsets are in code points.  The patterns equal the base ones match for match,
but never retry inside a run that has failed, so no text makes them quadratic.

Defined results: a NULL or empty text has no spans; overlapping spans of
different kinds are all listed; equal spans once; texts of any length are read
whole; repeated rows get equal results; an empty table gives an empty result;
other columns are not read.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    # a run begins only where another match or a foreign character ends; repeated groups are
    # possessive, which nothing after them could ever undo and which needs no stack
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[^\s@<>()\[\],;:]{1,64}@[^\s@<>()\[\],;:]{1,190}",
    "phone": r"[(]?[0-9][0-9 ().-]{5,38}[0-9]",
}
CONTEXT = 24
PRECISION, ROUNDS, LEARNING = 0.995, 24, 0.4
#: Words before a number that speak for a phone, an address or a card.
#: What stands beside or makes up a number that is a piece of code, a date, an amount or an address.
CODE_BEFORE = r"[\p{L}\p{N}_#/=$€£%@]\z|[0-9][,:]\z"
CODE_AFTER = r"^[\p{L}\p{N}_/=$€£%@]|^[,:][0-9]"
CODE = (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|^[0-9]{4}[-.][0-9]{1,2}[-.][0-9]{1,2}(?:[ -]|$)|^[0-9]{1,2}[-. ][0-9]{1,2}[-. ][0-9]{4}$"
        r"|^[0-9]+\.[0-9]+$")
PHONE_HINT = r"(?i)(?:tel|phone|fon|mobil|m[oó]vil|fax)\p{L}{0,8}[.: ]{1,3}\z"
AMOUNT = r"^[1-9][0-9]{0,2}(?:[. ][0-9]{3})+$"
HINTS = r"(?i)(tel|phone|fon|call|mobil|m[oó]vil|fax|card|visa|carte|karte|tarjeta|ip|host|mail)[^\n]{0,12}$"
BLOCK = 256


def _prefix_sums(lengths: Column) -> Column:
    """Sums of all before each element, in blocks, so that long lists stay linear."""
    count = F.size(lengths)
    block = lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x)
    sums = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(count - 1, F.lit(0)) / BLOCK).cast("int")), block)
    before = F.aggregate(sums, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    whole = F.transform(F.slice(before, 1, F.size(before) - 1), lambda start, b: F.aggregate(
        F.slice(lengths, b * BLOCK + 1, BLOCK), F.array(start),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)), lambda a: F.slice(a, 1, F.size(a) - 1)))
    return F.flatten(whole)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    chars = F.when(F.length(d) > 0, F.split(d, "")).otherwise(F.array().cast("array<string>"))
    total = F.aggregate(F.transform(chars, lambda c, i: F.when(i % 2 == 1, F.lit(2) * c.cast("int")).otherwise(c.cast("int"))),
                        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)) - F.when(x > 9, F.lit(9)).otherwise(F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # at most three digits after leading zeros, then at most 255
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return n.between(16, 19) & F.when(n.between(16, 19), _luhn(m)).otherwise(False)
    return n.between(8, 15)


#: (kind, pattern, generator): 0 for the base patterns, 1 for the loose ones.
GENERATORS = [(k, BASE[k], 0) for k in KINDS] + [(k, p, 1) for k, p in LOOSE.items()]


def with_candidates(docs: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """``keep`` and ``_c``, the candidates of each text: base ones first.

    Four projections, as what a list's elements refer to must be a column: an
    expression would be made again for every element.
    """
    every = range(len(GENERATORS))
    d = docs.select(*[c.alias(f"_k{i}") for i, c in enumerate(keep)], text.alias("_t"))
    kept = [f"_k{i}" for i in range(len(keep))]
    none = F.array().cast("array<string>")
    t = F.col("_t")

    def cut(i):
        kind, pattern, generator = GENERATORS[i]
        gate = t.contains("@") if kind == "email" else t.contains("+") if kind == "phone" and generator == 0 else t.rlike("[0-9]")
        return [F.when(gate, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"_m{i}"),
                F.when(gate, F.split(t, pattern, -1)).otherwise(none).alias(f"_p{i}")]

    d = d.select(*kept, *[c for i in every for c in cut(i)])
    def beside(i):  # each match with the text before and after it
        return F.transform(f"_m{i}", lambda m, j: F.struct(
            m.alias("m"), F.length(F.get(f"_p{i}", j)).alias("skip"), (F.length(F.get(f"_p{i}", j)) + F.length(m)).alias("n"),
            F.right(F.get(f"_p{i}", j), F.lit(CONTEXT)).alias("prev"), F.left(F.get(f"_p{i}", j + 1), F.lit(4)).alias("next")))

    def placed(i):
        return F.transform(f"_m{i}", lambda x, j: F.struct(
            (F.get(f"_a{i}", j) + x["skip"]).cast("int").alias("s"), (F.get(f"_a{i}", j) + x["n"]).cast("int").alias("e"),
            x["m"].alias("m"), x["prev"].alias("prev"), x["next"].alias("next")))

    d = d.select(*kept, *[beside(i).alias(f"_m{i}") for i in every])
    d = d.select(*kept, *[f"_m{i}" for i in every], *[_prefix_sums(F.col(f"_m{i}.n")).alias(f"_a{i}") for i in every])
    d = d.select(*kept, *[placed(i).alias(f"_m{i}") for i in every])
    return d.select(*kept, F.concat(*[_candidates(F.col(f"_m{i}"), *GENERATORS[i]) for i in every]).alias("_c"))


def _candidates(found: Column, kind: str, pattern: str, generator: int) -> Column:
    def row(x):
        m, prev, nxt = x["m"], x["prev"], x["next"]
        n = F.length(_digits(m))
        if generator == 0:
            named, good, open_, learn = F.lit(kind), _valid(kind, m), F.lit(False), F.lit(False)
        elif kind == "email":
            named, good = F.lit(kind), m.rlike(rf"^[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$")
            # one that holds a base match is covered by it
            open_ = m.rlike(r"@[^@]*[^\s@]\.\p{L}{2,}$") & ~m.rlike(BASE["email"])
            learn = good | (~open_ & ~m.rlike(BASE["email"]))
        else:
            dots = m.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$")
            named = F.when(dots, F.lit("ip")).when(n >= 16, F.lit("card")).otherwise(F.lit("phone"))
            code = (prev.rlike(CODE_BEFORE) | nxt.rlike(CODE_AFTER) | m.rlike(CODE) | (m.rlike(AMOUNT) & ~prev.rlike(HINTS)))
            good = (F.when(dots, F.when(dots, _valid("ip", m)).otherwise(False))
                    .when(n >= 16, _valid("card", m) & m.rlike(r"^[0-9](?:[ -]?[0-9])+$"))
                    .otherwise((prev.rlike(r"\+\z") & n.between(8, 15)) | (prev.rlike(PHONE_HINT) & n.between(8, 15) & ~code)))
            open_ = (named == "phone") & ~prev.rlike(r"\+[ ().0-9-]*\z") & n.between(6, 15) & ~code
            learn = (named != "phone") | good | code
            prev = F.regexp_replace(prev, r"\+\z", "")
        kindof = lambda c: (F.when(c == "", F.lit(0)).when(c.rlike(r"[\s]"), F.lit(1)).when(c.rlike(r"\p{L}"), F.lit(2))
                            .when(c.rlike("[0-9]"), F.lit(3)).when(c.isin("+", "(", "-", "."), F.lit(4)).otherwise(F.lit(5)))
        seps = F.length(m) - n
        return F.struct(
            named.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), (F.lit(generator == 0) & good).alias("base"),
            F.coalesce(good, F.lit(False)).alias("good"), F.coalesce(open_, F.lit(False)).alias("open"),
            F.coalesce(learn, F.lit(False)).alias("learn"),
            F.struct((seps > 0).cast("int").alias("grouped"),
                     F.when(named == "email", 0).when(named == "ip", 1).when(named == "card", 2).otherwise(3).alias("kind"),
                     F.when(n < 6, 0).when(n < 8, 1).when(n < 12, 2).when(n < 16, 3).when(n < 20, 4).otherwise(5).alias("digits"),
                     F.least(seps, F.lit(6)).alias("separators"),
                     kindof(F.right(prev, F.lit(1))).alias("before"), kindof(F.left(nxt, F.lit(1))).alias("after"),
                     F.when(n.between(12, 19), _luhn(m)).otherwise(False).cast("int").alias("luhn"),
                     m.contains("(").cast("int").alias("paren"), m.contains(".").cast("int").alias("dots"),
                     m.rlike(r"[^\s@]\.[A-Za-z]{2,}").cast("int").alias("domain"),
                     prev.rlike(HINTS).cast("int").alias("hint")).alias("f"))
    return F.transform(found, row)


FEATURES = ("grouped", "kind", "digits", "separators", "before", "after", "luhn", "paren", "dots", "domain", "hint")


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> list[tuple]:
    """(features, fold, labelled candidates, confirmed) over all documents.  Its rows are
    combinations of feature values, not documents: a bounded number."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    # the outer form: for explode, Spark would add a filter on the list's size and make the list twice
    c = with_candidates(docs, t, h).select(F.col("_k0").alias("_h"), F.explode_outer("_c").alias("c"))
    c = c.filter("c.learn")
    rows = (c.select((F.col("_h") % 5 == 0).alias("held"), F.col("c.good").cast("long").alias("good"), "c.f.*")
            .groupBy("held", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("y")))
    return sorted((tuple(r[f] for f in FEATURES), r["held"], r["n"], r["y"]) for r in rows.collect())


def fit_trees(rows: list[tuple], rounds: int = ROUNDS, rate: float = LEARNING):
    """Gradient boosting with the logistic loss on counted rows: a start score
    and trees ((feature, cut), (feature, cut, low, high) on either side)."""
    n, y = sum(r[2] for r in rows), sum(r[3] for r in rows)
    start = math.log((y + 1) / (n - y + 1))
    score, trees = [start] * len(rows), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g = [r[3] - r[2] * q for r, q in zip(rows, p)]
        h = [r[2] * q * (1 - q) for r, q in zip(rows, p)]

        def best(of):
            G, H = sum(g[i] for i in of), sum(h[i] for i in of)
            found = (0.0, None)
            for k in range(len(FEATURES)):
                by: dict = {}
                for i in of:
                    a = by.setdefault(rows[i][0][k], [0.0, 0.0])
                    a[0] += g[i]
                    a[1] += h[i]
                lg = lh = 0.0
                for v in sorted(by)[:-1]:
                    lg, lh = lg + by[v][0], lh + by[v][1]
                    gain = lg * lg / (lh + 1) + (G - lg) ** 2 / (H - lh + 1) - G * G / (H + 1)
                    if gain > found[0] + 1e-9:
                        found = (gain, (k, v))
            return found[1]

        leaf = lambda of: rate * sum(g[i] for i in of) / (sum(h[i] for i in of) + 1)
        root = best(range(len(rows)))
        if root is None:
            break
        tree = [root]
        for side in (True, False):
            of = [i for i in range(len(rows)) if (rows[i][0][root[0]] <= root[1]) == side]
            cut = best(of) or (0, -1)
            low, high = ([i for i in of if (rows[i][0][cut[0]] <= cut[1]) == s] for s in (True, False))
            a, b = (leaf(low) if low else 0.0), (leaf(high) if high else 0.0)
            tree.append((*cut, a, b))
            for i in of:
                score[i] += a if rows[i][0][cut[0]] <= cut[1] else b
        trees.append(tuple(tree))
    return start, trees


def tree_score(model, features) -> float:
    start, trees = model
    for (k, v), low, high in trees:
        j, w, a, b = low if features[k] <= v else high
        start += a if features[j] <= w else b
    return start


def thresholds(model, rows, precision: float = PRECISION) -> dict[int, float]:
    """Per kind the lowest score whose held-out candidates, from the best down,
    are confirmed at the wanted rate; infinite where none is."""
    out = {}
    for kind in range(len(KINDS)):
        held = sorted(((tree_score(model, r[0]), r[2], r[3]) for r in rows if r[0][FEATURES.index("kind")] == kind), reverse=True)
        n = y = 0
        out[kind] = math.inf
        for i, (s, c, d) in enumerate(held):
            n, y = n + c, y + d
            last = i + 1 == len(held) or held[i + 1][0] < s
            if last and n >= 20 and y >= precision * n:
                out[kind] = s
    return out


def _chosen(model, cuts: dict[int, float]):
    """candidate -> Column: a base span, or an open one with a score at or over its threshold."""
    start, trees = model

    def test(c):
        f = c["f"]
        x = lambda k: f[FEATURES[k]]
        leaf = lambda t: F.when(x(t[0]) <= t[1], F.lit(t[2])).otherwise(F.lit(t[3]))
        parts = [F.when(x(r[0]) <= r[1], leaf(lo)).otherwise(leaf(hi)) for r, lo, hi in trees]
        score = reduce(lambda a, b: a + b, parts, F.lit(float(start)))
        cut = F.lit(math.inf)
        for k, v in cuts.items():
            cut = F.when(f["kind"] == k, F.lit(float(v))).otherwise(cut)
        return c["base"] | (c["open"] & (score >= cut))
    return test


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = feature_table(docs, id_col, text_col)
    train, held = [r for r in rows if not r[1]], [r for r in rows if r[1]]
    model = fit_trees(train)
    test = _chosen(model, thresholds(model, held))
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = with_candidates(docs, t, F.col(id_col)).select(F.col("_k0").alias("doc_id"), F.filter("_c", test).alias("_c"))
    order = F.create_map(*[F.lit(x) for k, v in enumerate(KINDS) for x in (v, k)])

    def listed(spans: Column) -> Column:
        rows = F.array_distinct(F.array_sort(F.transform(spans, lambda c: F.struct(
            F.element_at(order, c["kind"]).alias("k"), c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind")))))
        return F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["kind"], r["s"].cast("string"), r["e"].cast("string"))), ",")

    base = F.filter("_c", lambda c: c["base"])
    count = lambda k: F.size(F.filter(base, lambda c: c["kind"] == k)).cast("long")
    return d.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                    F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("_c")).alias("spans"))

"""Merge replay, token alignment and the Merkle manifest against brute force on
NULLs, empty and long texts, ties, repeated rows, empty tables and other columns."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import llm_brute as brute

public_tokenizers = pytest.importorskip("public_tokenizers")
path = public_tokenizers.path


def texts():
    rng = random.Random(3)
    out = [None, "", " ", "  a  b \n c", "a b", " lead", "trail ", "a\x1cb \x1c c", "  x y z  ", "a▁b", "▁", "\t\t\n  x",
           "<|endoftext|> x <s> </s> <unk> <0x41>", "é日本🙂 " * 5, "é日本🙂 " * 5, "abab" * 40 + " " + "ababa" * 33,
           "aaaaaaaaab" * 300, "x" * 20_000, "word " * 4_000, "  nb sp  "]
    out += ["".join(rng.choice("abctheing 's\n\t 0é") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    out += [" ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 12))) for _ in range(40)) for _ in range(20)]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t) for i, t in enumerate(texts())]
    return out + [(None, "no id"), (None, None), (3, "twice"), (3, "twice"), (3, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return d.select("*", *(F.lit("clash").alias(c) for c in ("row", "pairs", "times", "n", "ids", "groups", "pos")))


@pytest.mark.parametrize("lead", [False, True])
def test_chunks_join_to_their_texts(lead):
    from casetrail.llm.chunks import chunked
    given = texts()
    starts, codes, chunks = chunked(pa.array(given).slice(2), lead)
    assert ["".join(chunks[c] for c in codes[a:b]) for a, b in zip(starts, starts[1:])] == [" " * lead + (t or "") for t in given[2:]]
    assert [len(x) for x in chunked(pa.array([], pa.string()), lead)] == [1, 0, 0]


def test_merge_replay_is_what_the_library_gives(docs, rows):
    import tiktoken
    from casetrail.llm.merge_replay import load_ranks, replay_tokens
    ranks = load_ranks(path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expect = Counter()
    for i, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        raw = (t or "").encode()
        expect[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest(), ids, raw] += 1
    whole = replay_tokens(docs, path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)
    assert Counter((*r[:4], bytes(r[4]), bytes(r[5])) for r in whole.collect()) == expect
    thin = replay_tokens(docs, path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    short = Counter()
    for e, n in expect.items():
        short[e[:4]] += n
    assert Counter(map(tuple, thin.collect())) == short
    assert replay_tokens(docs.limit(0), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect() == []


def test_replay_takes_lower_ranks_that_a_merge_makes_first():
    """Ranks out of the order of making: after (a, b), the pair (ab, c) ranks
    below it and goes before the next (a, b) of the word."""
    from casetrail.llm.merge_replay import MergeTable, replay
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 400, b"aba": 300, b"abab": 450}
    table = MergeTable(ranks)

    def plain(word):
        parts = [bytes([c]) for c in word]
        while True:
            best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    rng = random.Random(1)
    words = [b"", b"abab", b"ababab", *(bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14))) for _ in range(300))]
    assert [x.tolist() for x in replay(words, table)] == [plain(w) for w in words]


def test_a_pattern_that_matches_over_spaces_gets_whole_texts():
    import regex
    from casetrail.llm.merge_replay import MergeTable, ReplayEncoder, cuts_at_spaces
    assert cuts_at_spaces(regex.compile(public_tokenizers.PATTERN)) and not cuts_at_spaces(regex.compile(r"\S+ ?|\s"))
    table = MergeTable({bytes([i]): i for i in range(256)} | {b"a ": 300, b"a b": 301})
    ids, at = ReplayEncoder(table, r".+").encode(pa.array(["a b", None, "xa b"]))
    assert [np.frombuffer(ids[s:e], "<u4").tolist() for s, e in zip(at, at[1:])] == [[301], [], [120, 301]]


def test_alignment_refuses_tokenizers_that_it_can_not_cut():
    from casetrail.llm.token_alignment import Tokenizers
    with pytest.raises(ValueError):
        Tokenizers(path("word_bpe_49k.json"), path("piece_bpe_32k.model"))


def aligned_rows(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    from casetrail.llm.token_alignment import byte_of_letter
    a_lib = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib, alphabet = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model")), byte_of_letter()

    def spans(tokens):
        out, at = [], 0
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        return out

    def align(text):
        raw = (" " + text).encode() if text else b""
        a = [(i, bytes(alphabet[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + (text or ""), add_special_tokens=False).ids]
        pieces = [(i, b_lib.id_to_piece(i)) for i in b_lib.encode(text or "")]
        b = [(i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return [], [], [], []
        a, b = spans(a), spans(b)
        # both lists are in order: only neighbours can overlap
        links, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        group = {e: k for k, e in enumerate(cuts)}
        sides = [([], []) for _ in cuts]
        for side, tokens in ((0, a), (1, b)):
            k = 0
            for i, _, e in tokens:
                sides[k][side].append(str(i))
                if e in group:
                    k = group[e] + 1
        return a, b, links, [",".join(x) + "|" + ",".join(y) for x, y in sides]

    found = [(i, *align(t)) for i, t in rows]
    count = Counter(p for *_, links, _ in found for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return Counter((i, len(a), len(b), len(g), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, a, b, links, g in found)


@pytest.mark.parametrize("table_pairs", [1 << 20, 60, 0])
def test_alignment(docs, rows, table_pairs):
    """Whatever the broadcast table holds, all, some or none of the pairs."""
    from casetrail.llm.token_alignment import align_tokens
    got = align_tokens(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), table_pairs=table_pairs)
    assert Counter(map(tuple, got.collect())) == aligned_rows(rows)


def test_alignment_gives_its_groups_and_takes_empty_tables(docs, rows):
    from casetrail.llm.token_alignment import align_tokens
    got = align_tokens(docs, path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), with_groups=True).collect()
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] if r["groups"] else r["n_a"] == 0 for r in got)
    assert all(r["groups"].count(";") + 1 == r["n_groups"] for r in got if r["groups"])
    assert align_tokens(docs.limit(0), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")).collect() == []


def test_coalescing_breaks_where_a_start_reaches_the_running_maximum():
    from casetrail.llm.token_alignment import coalesce
    a, b = np.array([0, 2, 5, 6, 9]), np.array([0, 3, 5, 8, 9])
    ga, gb, lo, hi = coalesce(a[1:], a[:-1], b[:-1], b[1:])
    assert ga.tolist() == [0, 0, 1, 1] and gb.tolist() == [0, 0, 1, 1]
    assert list(zip(lo.tolist(), hi.tolist())) == [(0, 1), (0, 2), (2, 3), (2, 4)]


def manifest(rows, fan):
    """(doc_id, leaf, subroot, root, proof, folded, verified, siblings) the plain way."""
    h = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    leaf = lambda r: hashlib.sha256(b"".join(b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode())
                                             for v in r)).hexdigest()

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def way(levels, i):
        for row in levels[:-1]:
            s = i - i % fan
            yield row[s:i], row[i + 1:s + fan]
            i //= fan
    by, out = defaultdict(list), []
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    crown = tree([trees[s][-1][0] for s in sources])
    for k, s in enumerate(sources):
        for i, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            siblings, now = [*way(trees[s], i), *way(crown, k)], own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                now = leaf((*r[:4], r[4].translate(brute.LOWER)))
            for left, right in siblings:
                now = h([*left, now, *right])
            out.append((r[0], own, trees[s][-1][0], crown[-1][0], h([x for p in siblings for q in p for x in q]), now, now == crown[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("fan, levels", [(16, 3), (16, 1), (3, 1), (2, 2)])
def test_manifest(spark, fan, levels):
    """Any number of rounds and levels, with trees of one leaf, of uneven runs and over several blocks."""
    from casetrail.llm.merkle import merkle_manifest
    rows = [(i, "big", "en", 1, f"Text {i}") for i in range(300)] + [(1000 + i, f"é{i}", None, None, "Q") for i in range(20)]
    rows += [(None, None, None, None, None), (None, "zz", "en", 3, "Abc"), (5, "zz", "en", 3, "Abc"), (5, "zz", "en", 3, "Abc"),
             (5, "zz", "en", 3, "B"), (7, None, "x", 1, ""), (8, "", "x", 1, "Long " * 30_000)]
    rows += [(20, "copies", "en", 2, "Same")] * 40
    d = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    d = d.select(*(F.lit(7).alias(c) for c in ("tree", "block", "pos", "digest", "height", "at", "part")), "*")
    got = merkle_manifest(d, fan, levels)
    assert Counter(map(tuple, got.collect())) == manifest(rows, fan)


def test_manifest_of_one_and_no_row_and_real_proofs(spark):
    from casetrail.llm.merkle import digest, fold, merkle_manifest
    d = spark.createDataFrame([(1, "s", "en", 1, "A")], "doc_id long, source string, lang string, n_chars long, text string")
    r, = merkle_manifest(d, with_proof=True).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof"] == [] and r["proof_sha256"] == digest([])
    none = merkle_manifest(d.limit(0))
    assert none.collect() == [] and none.columns == list(r.asDict())[:-1]
    many = spark.createDataFrame([(i, f"s{i % 3}", "en", i, "a") for i in range(60)], d.schema)
    for r in merkle_manifest(many, with_proof=True).collect():
        assert fold(r["leaf"], [(p["left"], p["right"]) for p in r["proof"]]) == r["root"] and r["verified"]

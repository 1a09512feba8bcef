"""What a worker holds: one cache at a time, bounded steps, each text once."""
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casetrail.llm import merge_replay, pieces, suffix_dedup, token_planes, toxicity, word_cache
from casetrail.llm.queries import vocabulary
from casetrail.llm.toxicity import drop_toxic


def test_a_worker_keeps_the_last_cache_only(monkeypatch):
    monkeypatch.setattr(word_cache, "_caches", {})
    a = word_cache.worker_cache(("a",), lambda: word_cache.WordCache(list))
    assert word_cache.worker_cache(("a",), lambda: None) is a
    word_cache.worker_cache(("b",), lambda: word_cache.WordCache(list))
    assert list(word_cache._caches) == [("b",)]


def test_words_are_segmented_in_bounded_steps(monkeypatch):
    p = pieces.load_pieces(vocabulary("piece_bpe_32k.model"))
    words = [f"▁w{i}" for i in range(3 * pieces.STEP_WORDS + 1)]
    steps, many = [], pieces.segment_many
    monkeypatch.setattr(pieces, "segment_many", lambda p, new: steps.append(len(new)) or many(p, new))
    got = pieces.Segmenter(p).cache.values(words)
    assert max(steps) <= pieces.STEP_WORDS and sum(steps) == len(words)
    assert [list(memoryview(g).cast("I")) for g in got[::997]] == [pieces.segment(p, w) for w in words[::997]]


def test_texts_go_to_the_scorer_once(spark):
    docs = spark.createDataFrame([(i, "fine words" if i % 3 else None, "s") for i in range(40)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    left = drop_toxic(docs, labels)
    assert sorted(map(tuple, left.collect()), key=lambda r: r[0]) == sorted(map(tuple, docs.collect()), key=lambda r: r[0])
    plan = left._jdf.queryExecution().analyzed().toString().lower()
    assert "mapinarrow" in plan and "coalesce(text" not in plan


def test_words_that_recur_outlast_words_met_once():
    asked = []
    cache = word_cache.RecurringCache(lambda words: asked.extend(words) or [w.upper() for w in words], limit=400)
    held = lambda: sum(map(len, (cache.known, cache.older, cache.once, cache.once_older)))
    for k in range(100):
        words = ["often", "x" * 100, *(f"once{k}-{i}" for i in range(30)), "often"]
        assert cache.values(words) == [w.upper() for w in words]
        assert held() <= 400
    assert asked.count("often") == 1 and asked.count("x" * 100) == 100
    many = [f"w{i}" for i in range(1000)]
    assert cache.values(many) == [w.upper() for w in many] == cache.values(many) and held() <= 400


def test_stored_steps_give_workers_small_batches(spark, tmp_path):
    from casetrail.llm import common
    before = {k: spark.conf.get(k, None) for k in (common.ARROW_BYTES, common.CLEANUP)}

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 8000).alias("text"))
    got = [r["n"] for r in common.store(rows.mapInArrow(sizes, "n long"), str(tmp_path / "sizes")).collect()]
    assert len(got) > 2 and max(got) < 2 * common.BATCH_BYTES
    assert {k: spark.conf.get(k, None) for k in before} == before | {common.CLEANUP: before[common.CLEANUP] or "false"}


def test_spans_are_cut_out_by_batches_as_one_by_one():
    texts, spans = ["abcdef", "", "漢字漢字", "xyzxyz", "ab"], [[(2, 4), (0, 3), (4, 6)], None, [(3, 6), (9, 12)], [(0, 1), (2, 6), (3, 5)], []]
    batch = pa.record_batch([pa.array(range(10, 15), pa.int64()), pa.array(texts),
                             pa.array([s and [a << 32 | e for a, e in s] for s in spans], pa.list_(pa.int64()))], names=["doc_id", "text", "spans"])
    for part in (batch, batch.slice(1), batch.slice(3, 1)):
        got = [r for b in suffix_dedup._cut_out([part]) for r in b.to_pylist()]
        want = {10: (6, 6, 1, b""), 11: (0, 0, 0, b""), 12: (12, 6, 2, "漢漢".encode()), 13: (6, 5, 2, b"y"), 14: (2, 0, 0, b"ab")}
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == {
            i: (*want[i][:3], hashlib.sha256(want[i][3]).hexdigest()) for i in part.column(0).to_pylist()}


def test_runs_are_front_coded_in_blocks():
    run, twice = [b"", b"a", b"a\0", b"ab", b"abc", b"b", b"b" * 255], [True, False, True, False, False, True, False]
    for some in (1, 2, 100):
        got = list(suffix_dedup.front_decode(suffix_dedup.front_code(run, twice, some)))
        assert got == list(zip(run, [0, 0, 1, 1, 2, 0, 1], twice))
    assert suffix_dedup.front_code([], []) == b""


def test_training_holds_no_array_per_rare_feature():
    """Only features that a few rows hold get a place in the arrays of training; a text is not kept."""
    rng = np.random.default_rng(1)
    rows = [np.append(rng.choice(toxicity.FEATURES, 40, replace=False).astype(np.int32), np.int32([7, 9][i % 2])) for i in range(600)]
    tracemalloc.start()
    weights, _, prior = toxicity._trained(rows[::2], rows[1::2], 0.2, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20 and weights[7] > 0 > weights[9] and 0 < prior <= 0.5
    used, pos, unl = toxicity.narrowed(rows[::2], rows[1::2])
    assert {7, 9} <= set(used.tolist()) and all((np.append(used, -1)[a] == np.where(np.isin(b, used), b, -1)).all() for a, b in zip(pos, rows[::2]))


def test_replayed_ids_are_cut_by_word_from_one_run():
    """No array per word: the ids of all words, and where each word's begin, words without bytes too."""
    table = merge_replay.MergeTable({bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257, b"ba": 258})
    words = [b"", b"ababab", b"", b"bab", b"c", b""]
    ids, at = merge_replay.replay_all(words, table)
    assert [ids[s:e].tolist() for s, e in zip(at, at[1:])] == [[], [257, 256], [], [98, 256], [99], []] and ids.dtype == "<u4"
    assert merge_replay.replay_all([b"", b""], table)[1] == [0, 0, 0]


def test_ids_are_packed_without_an_array_per_word(monkeypatch):
    monkeypatch.setattr(word_cache, "encode_all", lambda path, words: iter([[1, 258], [], [65535]]))
    monkeypatch.setattr(word_cache.np, "asarray", None, raising=False)
    assert list(word_cache.packed_ids("", 2)(["a", "", "b"])) == [b"\x01\x00\x02\x01", b"", b"\xff\xff"]


def test_blocks_are_decoded_once(spark, tmp_path):
    """Documents inside a block and cut ones come from the same stored rows."""
    docs = spark.createDataFrame([(i, "some words " * (i % 7)) for i in range(60)] + [(None, None)], "doc_id long, text string")
    path = token_planes.encode_planes(docs, str(tmp_path / "files"), vocabulary("word_bpe_49k.json"), block_ids=32)
    got = token_planes.read_documents(spark, path)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == 1  # the one that joins cut documents; blocks are decoded before
    rows = sorted(got.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, *range(60)] and sum(r["n_tokens"] > 2 for r in rows) > 40
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))


def test_words_of_letters_are_encoded_together(monkeypatch):
    words = ["grumpf", "na\u00efve", "don't", "42", "\u0958a", "\u0130x", "\u6f22\u5b57", "<|endoftext|>", "x" * 100, "", *(f"w{'abcdefghij'[i % 10] * (i % 7)}" for i in range(40))]
    alone, every = [], word_cache.encode_all
    monkeypatch.setattr(word_cache, "encode_all", lambda path, some: alone.extend(some) or every(path, some))
    for name, lead, make in (("word_bpe_49k.json", "", lambda path: lambda w: [len(x) // 2 for x in word_cache.packed_ids(path, 2, " ")(w)]),
                             ("byte_bpe_50k.json", " ", lambda path: lambda w: list(word_cache.token_numbers(path, w)))):
        path = vocabulary(name)
        for odd in (True, False):  # letters that the normalizer takes apart: their group goes word by word
            some = [lead + w for w in words if odd or not {"\u0958", "\u0130"} & set(w)]
            alone.clear()
            assert make(path)(some) == [len(ids) for ids in every(path, some)]
            assert odd or not any("grumpf" in w for w in alone)
    path = vocabulary("word_bpe_49k.json")
    assert list(word_cache.packed_ids(path, 2, " ")(words)) == list(word_cache.packed_ids(path, 2)(words))

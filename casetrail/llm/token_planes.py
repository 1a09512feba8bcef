"""Token-id files with bit-plane shuffling.

Documents are range-partitioned and sorted by id, tokenized, and each gets the
end id.  A part's ids are cut into blocks of ``BLOCK_IDS``.  A block's ids are
transposed into byte planes (all low bytes, then all high bytes) or bit planes;
every plane is compressed with zstandard by itself.  The blocks are rows of a
Parquet dataset under the given folder, written by Spark's own committer, so
retried and speculative tasks leave no halves and the store may be any that
Spark can write:

  blocks/  part, block, first_id, n_ids, width, docs, planes (one binary each)
  index/   the chunk index: the same without docs and planes, with the id that
           the block starts at in the whole corpus, and its compressed size

``docs`` lists the pieces of documents inside the block, so a block can be read
without any other.  Word ends keep such a tokenizer from merging across white
space, so a batch's words are coded by Arrow, each distinct one is encoded once
through the worker's cache, and ids are gathered by code.  The tokenizer's file
is asked whether that holds; texts go to any other tokenizer whole.

Defined results: a NULL or empty text is the end id alone; rows with equal ids
are written one after the other, by text; NULL ids come first; a document may
span any number of blocks; an empty table makes no block; other columns are
not read.
"""
from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import gathered
from .common import run_dir, small_batches, store
from .word_cache import WordCache, encode_all, packed_ids, worker_cache

BLOCK_IDS = 1 << 16
#: Words that a worker remembers, and bytes of documents encoded at once.
CACHE_WORDS, BATCH_BYTES = 500_000, 8 << 20
LEVEL = 3
END_ID = 2

DOCS = "array<struct<doc_id:long,start:long,n_tokens:long,at:int,n:int>>"
BLOCK_SCHEMA = f"part int, block int, first_id long, n_ids int, width int, docs {DOCS}, planes array<binary>"
_DOC_TYPE = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                                ("at", pa.int32()), ("n", pa.int32())]))
_BLOCK_TYPE = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int32()),
                         ("width", pa.int32()), ("docs", _DOC_TYPE), ("planes", pa.list_(pa.binary()))])


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte (or bit) planes of little-endian unsigned ids, lowest first."""
    rows = ids.view(np.uint8).reshape(len(ids), ids.dtype.itemsize)
    if not bits:
        return [np.ascontiguousarray(rows[:, k]).tobytes() for k in range(rows.shape[1])]
    every = np.unpackbits(rows, axis=1, bitorder="little")
    return [np.packbits(every[:, k], bitorder="little").tobytes() for k in range(every.shape[1])]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    """The ids again; bit planes are told from byte planes by their number."""
    if len(planes) == width:
        rows = np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1)
    else:
        every = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        rows = np.packbits(every, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view(f"<u{width}").reshape(n)


#: A comma or full stop behind an ASCII letter or digit: neither NFC nor lower case makes marks of these.
_MARK = "([a-zA-Z0-9])([,.])"


def cuts_at_spaces(tokenizer_path: str) -> bool:
    """Whether the tokenizer encodes a text like its words, one by one, in lower case:
    it lower-cases, drops white space between pre-tokens, ends words with a suffix
    (so that none depends on what is beside it), cuts marks off letters,
    adds nothing around a text, and its special strings hold ``<|`` and no space."""
    with open(tokenizer_path, encoding="utf-8") as f:
        t = json.load(f)
    steps = lambda part, inner: [x for x in [part, *(part or {}).get(inner, [])] if x]
    normal, cut = steps(t["normalizer"], "normalizers"), steps(t["pre_tokenizer"], "pretokenizers")
    split = next((x for x in cut if x["type"] == "Split"), {"pattern": {}})
    words = regex.compile(split["pattern"].get("Regex", ""))
    return (any(x["type"] == "Lowercase" for x in normal) and bool(t["model"].get("end_of_word_suffix"))
            and t["post_processor"] is None and not any(x.get("add_prefix_space") for x in cut)
            and split.get("behavior") == "Removed" and split.get("invert", False)
            and words.findall("ab, c. d7.e") == ["ab", ",", "c", ".", "d", "7", ".", "e"]
            and all("<|" in a["content"] and not re.search(r"\s", a["content"]) for a in t["added_tokens"]))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(starts, codes, words): the codes of text i's parts between blanks and line
    ends lie from ``starts[i]`` to ``starts[i + 1]``.  Commas and full stops behind
    an ASCII letter or digit are cut off, as the tokenizer does, and ASCII texts put in lower case,
    which it does anyway (special tokens are looked for before): fewer distinct words."""
    texts = texts.cast(pa.large_string())
    for blank in "\n\t\r":
        texts = pc.replace_substring(texts, blank, " ")
    # the replaced texts are an array of their own: ascii_lower garbles slices of others
    plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
    texts = pc.if_else(plain, pc.ascii_lower(texts), texts)
    texts = pc.replace_substring_regex(texts, _MARK, r"\1 \2")
    parts = pc.split_pattern(texts, " ")
    starts = np.asarray(parts.offsets).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    return starts - starts[0], np.asarray(coded.indices), coded.dictionary.to_pylist()


class PlaneEncoder:
    """Ids of texts, ``width`` bytes each; words are remembered within bounds."""

    def __init__(self, tokenizer_path: str, width: int):
        self.path, self.width, self.whole = tokenizer_path, width, not cuts_at_spaces(tokenizer_path)
        self.words = WordCache(packed_ids(tokenizer_path, width, None if self.whole else " "), {"": b""}, limit=CACHE_WORDS)

    def encode(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """All ids, and each text's first byte among them (one more at the end)."""
        if self.whole:
            ids = [np.asarray(i, f"<u{self.width}").tobytes() for i in encode_all(self.path, texts.to_pylist())]
            return memoryview(b"".join(ids)), np.concatenate([[0], np.cumsum([len(i) for i in ids])]).tolist()
        starts, codes, words = word_codes(texts)
        data, at = gathered(self.words.values(words), codes)
        return data, at[starts].tolist()


def encode_planes(docs: DataFrame, path: str, tokenizer_path: str, width: int = 2, end_id: int = END_ID,
                  block_ids: int = BLOCK_IDS, bits: bool = False, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the files under ``path``; ``width`` is the bytes of an id (2 for
    vocabularies up to 65,536).  Returns ``path``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    kind = np.dtype(f"<u{width}")

    def write(batches):
        coder = worker_cache(("planes", tokenizer_path, width), lambda: PlaneEncoder(tokenizer_path, width))
        end, part, pack = np.asarray([end_id], kind).tobytes(), TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=LEVEL)
        pending, size, listed, block, first = [], 0, [], 0, 0  # bytes and documents of the open block

        def closed(payload: bytes, pieces: list):
            ids = np.frombuffer(payload, kind)
            planes = [pack.compress(p) for p in to_planes(ids, bits)]
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "first_id": first, "n_ids": len(ids),
                                                "width": width, "docs": pieces, "planes": planes}], schema=_BLOCK_TYPE)
        for b in small_batches(batches, BATCH_BYTES):
            data, cuts = coder.encode(b.column(1))
            for doc_id, s, e in zip(b.column(0).to_pylist(), cuts, cuts[1:]):
                ids = bytes(data[s:e]) + end
                n, start, at = len(ids) // width, first + size // width, 0
                while at < n:
                    take = min(n - at, block_ids - size // width)
                    pending.append(ids[at * width:(at + take) * width])
                    listed.append({"doc_id": doc_id, "start": start, "n_tokens": n, "at": at, "n": take})
                    size, at = size + take * width, at + take
                    if size == block_ids * width:
                        yield closed(b"".join(pending), listed)
                        block, first, pending, size, listed = block + 1, first + block_ids, [], 0, []
        if size:
            yield closed(b"".join(pending), listed)

    rows.mapInArrow(write, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    read_index(spark, path, blocks_only=True).write.parquet(f"{path}/index")
    return path


def read_index(spark: SparkSession, path: str, blocks_only: bool = False) -> DataFrame:
    """The chunk index: part, block, first_id, n_ids, width, n_planes, corpus_id."""
    if not blocks_only:
        return spark.read.parquet(f"{path}/index")
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "first_id", "n_ids", "width",
                                                         F.size("planes").alias("n_planes"))
    starts = part_starts(blocks)
    return blocks.join(starts, "part").withColumn("corpus_id", F.col("part_start") + F.col("first_id")).drop("part_start")


def part_starts(blocks: DataFrame) -> DataFrame:
    """part -> ids of all parts before it: one row per part file."""
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("part_start"))


_PIECE = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                    ("at", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary())])


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the little-endian 32-bit ``ids``)
    of every document, decoded from the files.

    Most documents lie inside one block.  Only the pieces of those that don't
    are shuffled, to be put together again.
    """
    def read(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in small_batches(batches):
            for part, n, width, docs, planes in zip(*(b.column(c) for c in ("part", "n_ids", "width", "docs", "planes"))):
                planes = [unpack.decompress(p) for p in planes.as_py()]
                ids = memoryview(from_planes(planes, n.as_py(), width.as_py()).astype("<u4").tobytes())
                doc_id, start, n_tokens, at, n = docs.values.flatten()
                whole = np.asarray(n) == np.asarray(n_tokens)
                cuts = np.append(0, 4 * np.cumsum(np.asarray(n).astype(np.int64))).tolist()
                own = [ids[s:e] for s, e in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [doc_id, pa.repeat(part, len(own)), start, n_tokens, at.cast(pa.int64()),
                     pa.array([zlib.crc32(i) if w else None for i, w in zip(own, whole.tolist())], pa.int64()),
                     pa.array([bytes(i) if with_ids or not w else None for i, w in zip(own, whole.tolist())], pa.binary())],
                    schema=_PIECE)

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # decoded once; both branches read the stored rows, which hold no ids of whole documents unless asked for
    pieces = store(blocks.mapInArrow(read, "doc_id long, part int, start long, n_tokens long, at long, crc long, ids binary"),
                   run_dir(spark, "pieces"))
    # the one column says which rows need their neighbours
    whole = pieces.filter("crc is not null").select("doc_id", "part", "start", "n_tokens", "crc", "ids")

    def join(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = b"".join(p["ids"] for p in r["pieces"])
                yield pa.RecordBatch.from_pylist([{"doc_id": r["doc_id"], "part": r["part"], "start": r["start"],
                                                   "n_tokens": r["n_tokens"], "crc": zlib.crc32(ids),
                                                   "ids": ids if with_ids else None}],
                                                 schema=pa.schema([f for f in _PIECE if f.name != "at"]))

    cut = (pieces.filter("crc is null").groupBy("doc_id", "part", "start", "n_tokens")
           .agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("pieces"))
           .mapInArrow(join, "doc_id long, part int, start long, n_tokens long, crc long, ids binary"))
    starts = part_starts(spark.read.parquet(f"{path}/index"))
    out = whole.unionByName(cut).join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"),
        *(["ids"] if with_ids else []))
    return out


def plane_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and read them back."""
    path = encode_planes(docs, run_dir(docs.sparkSession, "planes"), tokenizer_path, **options)
    return read_documents(docs.sparkSession, path)

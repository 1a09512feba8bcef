"""Merkle manifest of documents, by time-forward processing.

Every document is a leaf, every source a tree over its leaves in id order, and
the sources' roots are the leaves of one more tree.  A run of ``FAN`` consecutive
nodes is the child list of a parent until one node is left.

Going forward, a node's label (its level and its place) is the time at which it is
due: a child sends its digest to its parent's label, and a priority queue
ordered by label delivers the digests when the parent's time comes.  The queue
is external: between blocks of ``FAN ** LEVELS`` nodes it is Spark's exchange and
sort (messages addressed by tree and block, which spill to disk), and inside a
block a heap of that block's messages.  A round of blocks climbs ``LEVELS``
levels, so a few rounds do for any number of leaves.  A block does not know
whether its tree has others; it gives both digests, the one after all its
levels and the one at which a lone block's tree ends.

Going backward, the same blocks are swept from the last label to the first: a
parent delivers to each child the rest of its proof (the siblings on each
level above), the child puts its own siblings before it and passes it on, until the
leaves have theirs.

Leaves get their places from one range exchange over (source, id, leaf): digests
are shuffled, texts never are.  A source that holds a third of all rows is cut
by the ranges and blocks like any other.

Defined results: NULL in a column is ``-`` in its leaf; a NULL source is a source
of its own and comes first; a NULL id comes first in its source and is never
tampered with; rows with equal ids follow their leaves' digests, and rows that
are equal altogether are leaves side by side; a lone leaf is its source's
root, and its proof inside the source is empty; empty and very long texts are
hashed whole; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, IntegerType, LongType, StructField, StructType

from .common import ascii_lower, run_dir, small_batches, written

#: Children of a node, and levels that a block climbs (4,096 leaves to a block).
FAN, LEVELS = 16, 3
#: Where this divides the unsigned crc32 of the decimal id, the check tampers with the text.
TAMPER = 5

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(hexes: list[str]) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """H of the columns, each ``-`` or its UTF-8 byte count, ``:`` and value (32 bytes)."""
    parts = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
             for s in (c.cast("string") for c in columns)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _with(schema: StructType, **columns: DataType) -> StructType:
    return StructType([*schema.fields, *(StructField(n, t) for n, t in columns.items())])


def placed(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """``rows`` (their first column is the tree) with ``pos``, their place in
    their tree by ``order``.  They are written in ranges, and a range counts from where the ranges before it
    end; only a range's first tree can have begun earlier, so the table of such
    starts has no more rows than there are ranges."""
    tree = rows.columns[0]
    # rows that are equal altogether may go to different ranges: which is which does not matter
    keyed = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (*order, "_tie")]
    ranges = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    schema = ranges.schema

    def count(batches):
        part, last, n = TaskContext.get().partitionId(), (), 0
        for b in batches:
            at = []
            for t in b.column(0).to_pylist():
                n = n + 1 if (t,) == last else 0
                last = (t,)
                at.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                                             names=[*b.schema.names, "part", "at"])

    stored = written(ranges.mapInArrow(count, _with(schema, part=IntegerType(), at=LongType())), path)
    runs = stored.groupBy(F.col("part").alias("_part"), F.col(tree).alias("_tree")).agg((F.max("at") + 1).alias("_n"))
    before = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("_part", "_tree", F.sum("_n").over(before).alias("_start")).filter("_start > 0")
    return (stored.join(F.broadcast(starts), (F.col("part") == F.col("_part")) & F.col(tree).eqNullSafe(F.col("_tree")), "left")
            .select(*schema.names, (F.col("at") + F.coalesce("_start", F.lit(0))).alias("pos")))


def climb(leaves: list[str], fan: int, levels: int) -> list[list[str]]:
    """Digests of a block's nodes by level, its leaves first: messages to parents
    wait in a queue ordered by the parent's label (level, place)."""
    nodes = [leaves] + [[] for _ in range(levels)]
    queue = [(1, i // fan, i % fan, d) for i, d in enumerate(leaves)] if levels else []
    heapify(queue)
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heappop(queue)[3])
        made = digest(children)
        nodes[level].append(made)
        if level < levels:
            heappush(queue, (level + 1, place // fan, place % fan, made))
    return nodes


def lone_height(n: int, fan: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    height = 0
    while n > 1:
        n, height = -(-n // fan), height + 1
    return height


def descend(nodes: list[list[str]], height: int, fan: int, rest: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    """The proof of each of a block's leaves, as (siblings to the left, to the
    right) by level: labels in reverse order hand on what they were handed."""
    proofs = [rest] * len(nodes[height])
    for level in range(height - 1, -1, -1):
        row = nodes[level]
        proofs = [[("".join(row[i - i % fan:i]), "".join(row[i + 1:i - i % fan + fan])), *proofs[i // fan]]
                  for i in range(len(row))]
    return proofs


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    for left, right in proof:
        leaf = digest([left, leaf, right])
    return leaf


def rounds(places: int, fan: int, levels: int) -> int:
    """Rounds of blocks that leave one block of ``places`` nodes."""
    n, size = 1, fan ** levels
    while size < places:
        n, size = n + 1, size * fan ** levels
    return n


def forward(leaves: DataFrame, path: str, fan: int, levels: int, payload: list[str]) -> list[DataFrame]:
    """Blocks of every round from the leaves up (tree, block, nodes, and the
    digests they send on); ``leaves`` has tree, pos, digest and ``payload``."""
    top = leaves.agg(F.max("pos")).first()[0]
    if top is None:
        return []
    size, out = fan ** levels, []
    nodes = leaves.withColumns({"lone": F.col("digest"), "height": F.lit(0)})
    for r in range(rounds(top + 1, fan, levels)):
        inside = ["pos", "digest", "lone", "height", *(payload if r == 0 else [])]
        blocks = (nodes.groupBy("tree", F.expr(f"pos div {size}").alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct(*inside))).alias("nodes")))

        def send(batches, r=r):
            for b in small_batches(batches):
                rows = []
                for row in b.select(["nodes"]).to_pylist():
                    got = row["nodes"]
                    tree = climb([x["digest"].hex() for x in got], fan, levels)
                    if len(got) == 1:  # the tree ended before this round, if there is no other block
                        lone, height = got[0]["lone"], got[0]["height"]
                    else:
                        height = lone_height(len(got), fan)
                        lone, height = bytes.fromhex(tree[height][0]), height + r * levels
                    rows.append((bytes.fromhex(tree[levels][0]), lone, height))
                made = [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.binary(), pa.binary(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, "digest", "lone", "height"])

        schema = _with(blocks.schema, digest=BinaryType(), lone=BinaryType(), height=IntegerType())
        out.append(written(blocks.mapInArrow(send, schema), f"{path}-{r}"))
        nodes = out[-1].select("tree", F.col("block").alias("pos"), "digest", "lone", "height")
    return out


PROOF = "array<struct<left:string,right:string>>"
_PROOF = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _handed(row) -> list[tuple[str, str]]:
    return [(x["left"], x["right"]) for x in row["proof"]]


def backward(blocks: list[DataFrame], heads: DataFrame, path: str, fan: int, levels: int) -> DataFrame:
    """The first round's blocks with what their trees hand them; ``heads`` has tree,
    height (of the tree), proof (from its root on), subroot and root."""
    messages = heads.withColumn("block", F.lit(0).cast("long"))
    for r in range(len(blocks) - 1, 0, -1):
        def hand_on(batches, r=r):
            for b in small_batches(batches):
                for row in b.to_pylist():
                    nodes = climb([x["digest"].hex() for x in row["nodes"]], fan, levels)
                    proofs = descend(nodes, min(max(row["height"] - r * levels, 0), levels), fan, _handed(row))
                    n = len(proofs)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["tree"]] * n, pa.string()), pa.array([x["pos"] for x in row["nodes"]], pa.int64()),
                        pa.array([row["height"]] * n, pa.int32()),
                        pa.array([[{"left": a, "right": c} for a, c in p] for p in proofs], _PROOF),
                        pa.array([row["subroot"]] * n, pa.string()), pa.array([row["root"]] * n, pa.string())],
                        names=["tree", "block", "height", "proof", "subroot", "root"])

        messages = written(_delivered(blocks[r], messages).mapInArrow(
            hand_on, f"tree string, block long, height int, proof {PROOF}, subroot string, root string"), f"{path}-{r}")
    return _delivered(blocks[0], messages)


def _delivered(blocks: DataFrame, messages: DataFrame) -> DataFrame:
    b = blocks.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "nodes")
    return messages.join(b, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")


_OUT = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                  ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_()), ("proof", _PROOF)])
_SQL = {"doc_id": "long", "verified": "boolean", "proof": PROOF}


def merkle_manifest(docs: DataFrame, fan: int = FAN, levels: int = LEVELS, with_proof: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every
    document; ``with_proof`` adds the siblings themselves, level by level."""
    path = run_dir(docs.sparkSession, "merkle")
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    fields = [doc_id, *(F.col(c) for c in FIELDS[1:-1])]
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % TAMPER == 0
    leaves = docs.select(F.col("source").cast("string").alias("tree"), doc_id.alias("doc_id"), leaf_digest([*fields, text]).alias("digest"),
                         F.when(tampered, leaf_digest([*fields, ascii_lower(text)])).alias("tampered"))
    leaves = placed(leaves, ["tree", "doc_id", "digest"], f"{path}/leaves")
    blocks = forward(leaves, f"{path}/blocks", fan, levels, ["doc_id", "tampered"])
    out = pa.schema([f for f in _OUT if with_proof or f.name != "proof"])
    schema = ", ".join(f"{f.name} {_SQL.get(f.name, 'string')}" for f in out)
    if not blocks:
        return docs.sparkSession.createDataFrame([], schema)

    # the sources' roots are the leaves of the last tree
    subroots = blocks[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("lone").alias("digest"),
                                 F.col("height").alias("own"))
    subroots = placed(subroots, ["source"], f"{path}/subroots")
    crown = forward(subroots, f"{path}/crown", fan, levels, ["source", "own"])
    top = crown[-1].select("tree", "height", F.array().cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"),
                           F.lower(F.hex("lone")).alias("root"))

    def give_proofs(batches):
        for b in small_batches(batches):
            for row in b.to_pylist():
                nodes = climb([x["digest"].hex() for x in row["nodes"]], fan, levels)
                proofs = descend(nodes, min(row["height"], levels), fan, _handed(row))
                yield pa.RecordBatch.from_pylist([
                    {"tree": x["source"], "height": x["own"], "proof": [{"left": a, "right": c} for a, c in p],
                     "subroot": x["digest"].hex(), "root": row["root"]} for x, p in zip(row["nodes"], proofs)],
                    schema=pa.schema([("tree", pa.string()), ("height", pa.int32()), ("proof", _PROOF),
                                      ("subroot", pa.string()), ("root", pa.string())]))

    heads = written(backward(crown, top, f"{path}/crown-proofs", fan, levels).mapInArrow(
        give_proofs, f"tree string, height int, proof {PROOF}, subroot string, root string"), f"{path}/heads")

    def check(batches):
        for b in small_batches(batches):
            for row in b.to_pylist():
                members, root = row["nodes"], row["root"]
                nodes = climb([x["digest"].hex() for x in members], fan, levels)
                proofs = descend(nodes, min(row["height"], levels), fan, _handed(row))
                folded = [fold((x["tampered"] or x["digest"]).hex(), p) for x, p in zip(members, proofs)]
                n = len(members)
                columns = [[x["doc_id"] for x in members], nodes[0], [row["subroot"]] * n, [root] * n,
                           [digest([s for pair in p for s in pair]) for p in proofs], folded, [f == root for f in folded],
                           [[{"left": a, "right": c} for a, c in p] for p in proofs] if with_proof else None]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return backward(blocks, heads, f"{path}/proofs", fan, levels).mapInArrow(check, schema)

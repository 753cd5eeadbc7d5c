"""Merkle manifest of a dataset by time-forward processing: one digest for all rows, and for each row the proof that it is in.

Rows of a group (a source) are leaves in order; 16 consecutive nodes have one parent, and the groups' roots are the leaves of
one more tree. A node's label is its place in the order in which children come before parents: (last leaf below it,
level). Work goes along the labels, and a node's results are sent forward in time to the nodes that need them, by a priority
queue ordered by label:

* `sweep_up` meets leaves by ascending label; each node sends its digest to its parent. A parent is taken from the queue as
  soon as the leaves have passed its label, so its children's digests lie next to each other at the head of the queue.
* `sweep_down` meets all nodes by descending label; each node sends its children the proof's suffix from itself to the root.

The queue is external: the messages that cross from one block of 4096 leaves to the next stratum are tables, which Spark's
shuffle deals by (tree, block) and sorts by label, spilling as needed; messages inside a block wait in a heap of at most 16
for each of three levels. So a tree of n leaves takes ceil(log4096 n) strata, a group of any share of all rows is as many
blocks as it has 4096 leaves, and no task, nor the driver, holds more than one block's path. The driver sees one number a
stratum: the nodes of the largest tree.

Defined cases: a null in any column is written `-`; rows that repeat a key are leaves of their own, in order of their digest;
null keys come first; the null group comes first; a tree of one leaf is that leaf; no rows give an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm import shared

FAN = 16
LEVELS = 3
BLOCK = FAN**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

UP = "tree string, block long, last long, level int, run array<string>, digest string, top boolean, nodes long"
DOWN = "tree string, pos long, payload struct<id:long,leaf:string,tampered:string>, path array<string>, subroot string, root string, proof_sha256 string, folded_root string"


def digest_of(values: dict[str, Column]) -> Column:
    """H of a row: each value's UTF-8 byte count, a colon and the value, or - for null."""
    texts = [v.cast("string") for v in values.values()]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def hexed(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes: int) -> int:
    """Levels above `nodes` leaves, of those that one stratum has."""
    n, out = nodes, 0
    while n > 1 and out < LEVELS:
        n, out = -(-n // FAN), out + 1
    return out


def place(leaves: DataFrame) -> DataFrame:
    """(tree, order key columns o1, o2, payload, digest) -> tree, nodes, pos, payload, digest: places in each tree from 0.

    Rows are sorted by range; each partition numbers its rows of a tree, and what earlier partitions have of it is
    added. Both tables are cut, so a place never changes when a task runs again.
    """
    n_parts = shared.partitions(leaves.sparkSession)
    in_order = leaves.repartitionByRange(n_parts, "tree", "o1", "o2").sortWithinPartitions("tree", "o1", "o2")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, k = TaskContext.get().partitionId(), None, 0
        for b in batches:
            places = []
            for t in b.column("tree").to_pylist():
                tree, k = t, k + 1 if t == tree else 0
                places.append(k)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("tree", "payload", "digest")] + [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], names=["tree", "payload", "digest", "part", "k"])

    payload = leaves.schema["payload"].dataType.simpleString()
    numbered = shared.cut(in_order.mapInArrow(number, f"tree string, payload {payload}, digest string, part int, k long"), "merkle-numbered")
    counts = numbered.groupBy("tree", "part").agg((F.max("k") + 1).alias("n"))
    # no tree has more rows here than there are partitions
    part = W.partitionBy("tree").orderBy("part")
    before = counts.select("tree", "part", (F.sum("n").over(part) - F.col("n")).alias("first"), F.sum("n").over(W.partitionBy("tree")).alias("nodes"))
    return numbered.join(before, ["tree", "part"]).select("tree", "nodes", (F.col("first") + F.col("k")).alias("pos"), "payload", "digest")


def sweep_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves by tree, block and pos -> inner nodes; a block's last one has top."""
    here, top, queue = None, 0, []  # queue: (label of the parent, child's number, child's digest)

    def taken(until: int) -> Iterator[tuple]:
        """Nodes with a label before leaf `until`: their children's messages are the head of the queue."""
        while queue and queue[0][0][0] < until:
            label, run = queue[0][0], []
            while queue and queue[0][0] == label:
                run.append(heapq.heappop(queue)[2])
            last, level = label
            own = hexed(run)
            yield (*here[:2], last, level, run, own, level == top, here[2])
            send(last // FAN**level, level, own)

    def send(number: int, level: int, digest: str) -> None:
        if level < top:
            heapq.heappush(queue, (((number // FAN + 1) * FAN ** (level + 1) - 1, level + 1), number, digest))

    for b in batches:
        out = []
        for tree, block, nodes, pos, digest in zip(*(b.column(c).to_pylist() for c in ("tree", "block", "nodes", "pos", "digest")), strict=True):
            if here is None or here[:2] != (tree, block):
                out.extend(taken(BLOCK + 1))
                here, top = (tree, block, nodes), levels_of(nodes)
            i = pos % BLOCK
            out.extend(taken(i))
            if top == 0:
                out.append((tree, block, i, 0, None, digest, True, nodes))
            send(i, 0, digest)
        yield _inner(out)
    yield _inner(list(taken(BLOCK + 1)))


def _inner(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.int64())
    columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in UP.split(", ")])


def fold(digest: str, path: list[str]) -> str:
    """The root that follows from a leaf and its path: left and right siblings, joined, of each level."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


def sweep_down(lowest: bool):
    """Leaves, inner nodes and each block's message from above, by tree, block and descending label -> leaves with their
    paths; in the lowest stratum with what follows from the paths instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[tuple] = []  # (-last leaf, -level, path)
        above = (None, None)
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for tree, last, level, pos, run, payload, digest, path, subroot, root in zip(*(b.column(c).to_pylist() for c in ("tree", "last", "level", "pos", "run", "payload", "digest", "path", "subroot", "root")), strict=True):
                if path is not None:  # the message to the block's top, which comes next
                    queue, above = [(-BLOCK, 0, path)], (subroot, root)
                    continue
                own = heapq.heappop(queue)[2]
                if level > 0:
                    first = last // FAN**level * FAN
                    for i in range(len(run)):
                        child = ((first + i + 1) * FAN ** (level - 1) - 1, level - 1)
                        heapq.heappush(queue, (-child[0], -child[1], ["".join(run[:i]), "".join(run[i + 1 :]), *own]))
                else:
                    ends = (None, hexed(own), fold(payload["tampered"] or digest, own)) if lowest else (own, None, None)
                    for column, x in zip(out, (tree, pos, payload, ends[0], *above, *ends[1:]), strict=True):
                        column.append(x)
            payload_kind = pa.struct([("id", pa.int64()), ("leaf", pa.string()), ("tampered", pa.string())])
            kinds = (pa.string(), pa.int64(), payload_kind, pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["tree", "pos", "payload", "path", "subroot", "root", "proof_sha256", "folded_root"])

    return run


def climb(leaves: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Leaves (tree, nodes, pos, payload, digest) -> the strata, each its nodes and inner nodes, and (tree, digest) of the roots."""
    strata, nodes = [], leaves.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    while True:
        dealt = nodes.select("tree", "block", "nodes", "pos", "digest").repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        inner = shared.cut(dealt.mapInArrow(sweep_up, UP), "merkle-inner")
        strata.append((nodes, inner))
        tops = inner.where("top").select("tree", F.ceil(F.col("nodes") / BLOCK).cast("long").alias("nodes"), F.col("block").alias("pos"), _no_payload(), "digest")
        if (inner.agg(F.max("nodes").alias("n")).first()["n"] or 0) <= BLOCK:
            return strata, tops.select("tree", "digest")
        nodes = tops.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))


def _no_payload() -> Column:
    return F.lit(None).cast("struct<id:long,leaf:string,tampered:string>").alias("payload")


def descend(strata: list[tuple[DataFrame, DataFrame]], messages: DataFrame, with_paths: bool = False) -> DataFrame:
    """messages (tree, block, path, subroot, root) to the tops of the highest stratum -> the leaves with their paths or proofs."""
    for nodes, inner in reversed(strata):
        lowest = nodes is strata[0][0]
        null = lambda kind: F.lit(None).cast(kind)
        texts = null("array<string>").alias("path"), null("string").alias("subroot"), null("string").alias("root")
        payload = F.struct("payload.id", "payload.leaf", "payload.tampered")
        rows = nodes.select("tree", "block", F.pmod("pos", F.lit(BLOCK)).alias("last"), F.lit(0).alias("level"), "pos", null("array<string>").alias("run"), payload.alias("payload"), "digest", *texts)
        rows = rows.unionByName(inner.where("level > 0").select("tree", "block", "last", "level", null("long").alias("pos"), "run", _no_payload(), "digest", *texts))
        rows = rows.unionByName(messages.select("tree", "block", F.lit(BLOCK).cast("long").alias("last"), F.lit(LEVELS + 1).alias("level"), null("long").alias("pos"), null("array<string>").alias("run"), _no_payload(), null("string").alias("digest"), "path", "subroot", "root"))
        dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", F.desc("last"), F.desc("level"))
        out = dealt.mapInArrow(sweep_down(lowest and not with_paths), DOWN)
        messages = out.select("tree", F.col("pos").alias("block"), "path", "subroot", "root")
        if not lowest:
            messages = shared.cut(messages, "merkle-messages")
    return out


def tree_key(group: Column) -> Column:
    """A text that sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def prove(leaves: DataFrame) -> DataFrame:
    """(tree, id, leaf, tampered) -> one row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    tampered: the digest of a changed row, from which folded_root then follows; null where the row is as it was.
    """
    payload = F.struct("id", "leaf", "tampered")
    placed = place(leaves.select("tree", F.col("id").alias("o1"), F.col("leaf").alias("o2"), payload.alias("payload"), F.col("leaf").alias("digest")))
    placed = shared.cut(placed, "merkle-placed")
    shared.free_shuffles(leaves.sparkSession)
    strata, subroots = climb(placed)
    top = place(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("o1"), F.lit("").alias("o2"), F.struct(F.lit(None).cast("long").alias("id"), F.col("tree").alias("leaf"), F.lit(None).cast("string").alias("tampered")).alias("payload"), "digest"))
    top = shared.cut(top, "merkle-top")
    top_strata, roots = climb(top)
    first = roots.select("tree", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    found = descend(top_strata, first, with_paths=True)
    subroot = subroots.select("tree", F.col("digest").alias("own"))
    paths = found.select(F.col("payload.leaf").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "root").join(subroot, "tree").withColumnRenamed("own", "subroot")
    out = descend(strata, shared.cut(paths, "merkle-paths"))
    return out.select(F.col("payload.id").alias("doc_id"), F.col("payload.leaf").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def document_leaves(documents: DataFrame) -> DataFrame:
    """documents -> tree, id, leaf, tampered: where 5 divides crc32 of the doc_id, the digest with the text lower-cased."""
    values = {c: F.col(c) for c in COLUMNS}
    changed = F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 5 == 0, digest_of(values | {"text": lowered(F.col("text"))}))
    return documents.select(tree_key(F.col("source")).alias("tree"), F.col("doc_id").alias("id"), digest_of(values).alias("leaf"), changed.alias("tampered"))


def manifest(documents: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof and verdict of every document."""
    return prove(shared.cut(document_leaves(documents), "merkle-leaves"))

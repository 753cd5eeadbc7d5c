"""Centroid clustering with a vantage-point tree over the centroids, exact in whole numbers.

Each round the driver builds a vantage-point tree over the k centroids (k * width numbers, whatever the table's size) and
broadcasts it. Tasks read vectors in Arrow batches and search the tree best first, all vectors of a slice at once: each
vector opens its node with the least lower bound until that bound is beyond its best distance. The pruning radius is
inclusive, so centroids at the very distance of the best are met too and the smaller number wins. Bounds come from the
triangle inequality on square roots, with a margin wider than their rounding; distances that decide are exact
sums of squares in whole numbers. A task returns k * width sums, which are added up by Spark before the driver sees k * width
totals; vectors are written once, read each round and never shuffled.

Defined cases: vectors that are null, of another length, or hold a null, NaN or infinite component take no part; a null
vec_id is assigned, but starts no centroid; rows that repeat a vec_id are vectors of their own, the smaller vector first
among equal starts; with fewer vectors than k there are as many centroids as vectors; equal distances go to the smaller number; a
centroid without vectors stays; an empty table gives no rows. Components of 2^27 and more in size after scaling have no
squared distance in a long: as with any overflow under ANSI rules, the query fails and says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import shared

K = 16
ROUNDS = 3
SCALE = 64
WIDTH = 64
LEAF = 4
LARGEST = 1 << 27
#: Vectors searched at once.
SLICE = 4096
#: Relative margin of the bounds; their rounding is below 1e-14.
MARGIN = 1e-9


def whole_numbers(vectors: DataFrame, scale: int = SCALE, width: int = WIDTH) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, v array<bigint>) with floor(scale * x) of each component; unusable vectors dropped."""
    x = F.col("embedding")
    sound = (F.size(x) == width) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    y = lambda c: F.floor(c.cast("double") * scale)
    fits = lambda c: F.when(F.abs(c.cast("double") * scale) < LARGEST, y(c)).otherwise(F.raise_error(F.lit("a component of 2^27 or more in size: squared distances overflow a long")).cast("long"))
    return vectors.where(x.isNotNull() & sound).select("vec_id", F.transform(x, fits).alias("v"))


@dataclass
class Node:
    """A leaf's centroids; or an inner node's vantage point, with each child's span of distances from it."""

    items: np.ndarray
    spans: tuple = ()
    children: tuple = ()


class VantageTree:
    """Nodes in the order in which they were built, the root first."""

    def __init__(self, centroids: np.ndarray):
        self.points, self.nodes = centroids, []
        self._build(np.arange(len(centroids)))

    def _build(self, items: np.ndarray, whole: bool = False) -> int:
        """Number of the node over items; whole: as one leaf, for items that no distance parts."""
        at = len(self.nodes)
        self.nodes.append(Node(items))
        if len(items) > LEAF and not whole:
            vantage, rest = items[0], items[1:]
            d = np.sqrt(self.distances(self.points[rest], vantage).astype(float))
            near = d <= np.median(d)
            parts = [m for m in (near, ~near) if m.any()]
            spans = tuple((d[m].min(), d[m].max()) for m in parts)
            self.nodes[at] = Node(items[:1], spans)
            self.nodes[at].children = tuple(self._build(rest[m], whole=len(parts) == 1) for m in parts)
        return at

    def distances(self, x: np.ndarray, centroid: int) -> np.ndarray:
        gap = x - self.points[centroid]
        return np.einsum("ij,ij->i", gap, gap)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row, the smaller number among equals."""
        n, none = len(x), len(self.points)
        best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, none)
        bounds = np.full((n, len(self.nodes)), np.inf)
        bounds[:, 0] = 0
        open_rows = np.arange(n)
        while len(open_rows):
            node_of = bounds[open_rows].argmin(axis=1)
            least = bounds[open_rows, node_of]
            worth = np.isfinite(least) & ((who[open_rows] == none) | (least * (1 - MARGIN) <= np.sqrt(best[open_rows].astype(float))))
            open_rows, node_of = open_rows[worth], node_of[worth]
            for number in np.unique(node_of).tolist():
                node, rows = self.nodes[number], open_rows[node_of == number]
                floor = bounds[rows, number]
                for c in node.items.tolist():
                    d = self.distances(x[rows], c)
                    better = (d < best[rows]) | ((d == best[rows]) & (c < who[rows]))
                    best[rows[better]], who[rows[better]] = d[better], c
                for child, (low, high) in zip(node.children, node.spans, strict=True):
                    away = np.sqrt(d.astype(float))  # from the vantage point, the node's one item
                    bounds[rows, child] = np.maximum(floor, np.maximum(low - away, away - high) - MARGIN * (away + high))
                bounds[rows, number] = np.inf
        return who, best


def _rows(b: pa.RecordBatch, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, b.num_rows, SLICE):
        part = b.slice(at, SLICE)
        yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def start(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors with the smallest digests of their ids, in that order: k rows, by a top-k of each task."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).select("v", key.alias("key")).orderBy("key", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), len(rows[0]["v"]) if rows else WIDTH)


def totals(vectors: DataFrame, tree: VantageTree) -> DataFrame:
    """cluster, place, total, n: sums of each component over each cluster, added up in every task first."""
    sent, (k, width) = vectors.sparkSession.sparkContext.broadcast(tree), tree.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("centroids")
        total, n = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            for _, x in _rows(b, width):
                who, _ = sent.value.nearest(x)
                order = np.argsort(who, kind="stable")
                found, first = np.unique(who[order], return_index=True)
                total[found] += np.add.reduceat(x[order], first, axis=0)
                n += np.bincount(who, minlength=k)
        some = np.flatnonzero(n)
        columns = np.repeat(some, width), np.tile(np.arange(width), len(some)), total[some].ravel(), np.repeat(n[some], width)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cluster", "place", "total", "n"])

    parts = vectors.select("v").mapInArrow(run, "cluster long, place long, total long, n long")
    return parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Non-empty centroids at the floor of their vectors' mean."""
    out = centroids.copy()
    for r in sums.collect():  # k * width rows
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance."""
    sent, width = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids)), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("centroids")
        for b in batches:
            for part, x in _rows(b, width):
                who, distance = sent.value.nearest(x)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(who, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after the rounds, from vectors (vec_id, v) that are read in every round."""
    centroids = start(vectors, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(centroids, totals(vectors, VantageTree(centroids)))
    return centroids


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def cluster(spark: SparkSession, vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, v) -> RESULT, one row per vector."""
    kept = shared.cut(vectors, "centroids-vectors")
    centroids = fit(kept, k, rounds)
    if not len(centroids):
        # vectors without any id start no centroid: there is nothing that they could belong to
        return spark.createDataFrame([], RESULT)
    assigned = shared.cut(assign(kept, centroids), "centroids-assigned")
    shared.forget(kept)
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, s, sum(sums.values()), digests[c]) for c, s in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(*(c.split()[0] for c in RESULT.split(", ")))

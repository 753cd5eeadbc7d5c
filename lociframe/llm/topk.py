"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt into blocks of bounded size; each block holds one list of its vectors per dimension, sorted
by value. A query walks all lists at once, downwards for a positive weight and upwards for a negative one,
scores each vector that it meets in full, and stops when the bound on everything unseen, the inner product
with the values at the present depth, is below its kth score. On equality it goes on, as a tie with a
smaller id may still come. The k best of each block are then ranked.

Every block of queries meets every block of candidates once: a stated set of queries against all rows.
Both sides are dealt by salt, so hot vectors spread. Neither side is broadcast or collected.

Defined cases: a query id that repeats is asked once, with its smallest vector; vectors that are null or hold a null, NaN or infinite component take no part; missing components of
shorter vectors count as 0; equal scores go by smaller vec_id; rows that repeat a vec_id are candidates of
their own; a query never meets rows with its own vec_id; empty tables give no rows; a null vec_id takes no part.
Scores are exact while they fit in a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SCALE = 1024


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, v array<bigint>) with floor(1024 x) of each component; unusable vectors dropped."""
    x = F.col("embedding")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & sound).select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"))


class SortedLists:
    """Per-dimension lists of a block, in ascending order of value."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], np.ascontiguousarray(rows[order])
        self.lists = np.argsort(self.rows, axis=0, kind="stable")
        self.values = np.take_along_axis(self.rows, self.lists, axis=0)

    def best(self, own: int, q: np.ndarray, k: int, first: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best for q, without rows of id own."""
        n, seen = len(self.ids), np.zeros(len(self.ids), dtype=bool)
        up, down = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
        seen[self.ids == own] = True
        kept, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        at, step = 0, first
        while at < n:
            to = min(n, at + step)
            met = np.zeros(n, dtype=bool)
            met[self.lists[n - to : n - at][:, down].ravel()] = True
            met[self.lists[at:to][:, up].ravel()] = True
            if not len(up) and not len(down):
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            kept, scores = np.concatenate([kept, new]), np.concatenate([scores, self.rows[new] @ q])
            if len(kept) > k:
                top = np.lexsort((kept, -scores))[:k]
                kept, scores = kept[top], scores[top]
            at, step = to, step * 2
            if at < n and len(kept) == k and scores.min() > self.values[n - at][down] @ q[down] + self.values[at - 1][up] @ q[up]:
                break
        top = np.lexsort((kept, -scores))[:k]
        return self.ids[kept[top]], scores[top]


def _wide(columns: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(columns), width), dtype=np.int64)
    for i, x in enumerate(columns):
        out[i, : len(x)] = x
    return out


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qs, cs = (t.column("v").to_pylist() for t in (left, right))
        found = {"query_id": [], "vec_id": [], "score": []}
        if qs and cs:
            width = max(map(len, (*qs, *cs)))
            lists = SortedLists(right.column("vec_id").to_numpy(), _wide(cs, width))
            for own, q in zip(left.column("vec_id").to_pylist(), _wide(qs, width), strict=True):
                ids, scores = lists.best(own, q, k)
                found["query_id"] += [own] * len(ids)
                found["vec_id"] += ids.tolist()
                found["score"] += scores.tolist()
        return pa.table({n: pa.array(x, pa.int64()) for n, x in found.items()})

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, block_rows: int = 4096, query_rows: int = 1024) -> DataFrame:
    """queries and candidates (vec_id, v array<bigint>) -> query_id, rank, vec_id, score."""
    n_blocks = max(1, -(-candidates.count() // block_rows))
    n_query_blocks = max(1, -(-queries.count() // query_rows))  # both counts only set the sizes of blocks
    salt = lambda n: F.pmod(F.xxhash64("vec_id", F.size("v")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.groupBy("vec_id").agg(F.min("v").alias("v")).select("vec_id", "v", salt(n_query_blocks).alias("q_block"), every(n_blocks).alias("c_block"))
    right = candidates.select("vec_id", "v", salt(n_blocks).alias("c_block"), every(n_query_blocks).alias("q_block"))
    keys = ("q_block", "c_block")
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Likelihood of reads given haplotypes: a three-state pair model, computed for many pairs at once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

GAP_CONTINUES = 0.1
NO_SCORE = -1000.0


def forward(reads: np.ndarray, haps: np.ndarray, quals: np.ndarray, gap_quals: np.ndarray) -> np.ndarray:
    """log10 likelihoods of pairs of equal shapes: bases (pairs, m) and (pairs, n), base and gap-opening qualities (pairs, m)."""
    pairs, m = reads.shape
    n = haps.shape[1]
    error = 10.0 ** (-quals / 10)
    opens = 10.0 ** (-gap_quals / 10)
    stays = np.maximum(0.0, 1 - 2 * opens)
    unknown = ord("N")
    match, insert = np.zeros((pairs, n + 1)), np.zeros((pairs, n + 1))
    delete = np.full((pairs, n + 1), 1.0 / n)
    for i in range(m):
        base, e = reads[:, i, None], error[:, i, None]
        prior = np.where((haps == base) | (base == unknown) | (haps == unknown), 1 - e, e / 3)
        below, into = match, insert
        match, insert = np.zeros_like(match), np.zeros_like(insert)
        match[:, 1:] = prior * (below[:, :-1] * stays[:, i, None] + (into[:, :-1] + delete[:, :-1]) * (1 - GAP_CONTINUES))
        insert[:, 1:] = below[:, 1:] * opens[:, i, None] + into[:, 1:] * GAP_CONTINUES
        delete = np.zeros_like(delete)
        for j in range(1, n + 1):
            delete[:, j] = match[:, j - 1] * opens[:, i] + delete[:, j - 1] * GAP_CONTINUES
    total = (match + insert)[:, 1:].sum(axis=1)
    return np.where(total > 0, np.log10(np.maximum(total, 1e-320)), NO_SCORE)


def score(pairs: DataFrame, gap_quality: int = 45) -> DataFrame:
    """(read_id, hap_id, seq, qual array<int>, hap) -> read_id, hap_id, score. Pairs are scored where they lie, batch by batch."""
    kinds = dict(pairs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shapes = defaultdict(list)
            seqs, haps, quals = (b.column(c).to_pylist() for c in ("seq", "hap", "qual"))
            out = np.full(b.num_rows, NO_SCORE)
            for k, (s, h) in enumerate(zip(seqs, haps, strict=True)):
                if s and h:
                    shapes[len(s), len(h)].append(k)
            for rows in shapes.values():
                letters = lambda xs: np.array([list(xs[k].encode()) for k in rows])  # noqa: B023, E731
                q = np.array([quals[k] for k in rows], dtype=float)
                out[rows] = forward(letters(seqs), letters(haps), q, np.full_like(q, gap_quality))
            yield pa.RecordBatch.from_arrays([b.column("read_id"), b.column("hap_id"), pa.array(out)], names=["read_id", "hap_id", "score"])

    return pairs.mapInArrow(run, f"read_id {kinds['read_id']}, hap_id {kinds['hap_id']}, score double")

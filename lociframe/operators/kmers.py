"""Edges of a k-mer graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096


def edges(sequences: DataFrame, k: int) -> DataFrame:
    """Sequences (seq) -> src, dst, multiplicity of each pair of neighbouring k-mers.

    A sequence is cut into chunks that overlap by k, and one pass of a pattern that looks ahead lists a chunk's (k + 1)-mers, so the
    work is linear in the length. One key counts, and its two halves are taken after counting.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length("seq") - k, F.lit(1)), F.lit(CHUNK))
    chunks = sequences.where(F.length("seq") > k).select(F.explode(F.transform(starts, lambda i: F.substr("seq", i, F.lit(CHUNK + k)))).alias("chunk"))
    mers = chunks.select(F.explode(F.regexp_extract_all("chunk", F.lit(f"(?=(.{{{k + 1}}}))"), F.lit(1))).alias("mer"))
    counts = mers.groupBy("mer").agg(F.count("*").alias("multiplicity"))
    return counts.select(F.substring("mer", 1, k).alias("src"), F.substring("mer", 2, k).alias("dst"), "multiplicity")

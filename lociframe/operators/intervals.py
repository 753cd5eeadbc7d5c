"""Interval algebra on (contig, start, end) tables, 1-based inclusive unless stated otherwise."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.overlap import overlap_join


BIN = 1 << 16


def running(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], value: Column, how: Callable, name: str, before: bool = False) -> DataFrame:
    """Adds the running `how` (F.max or F.sum) of value in order inside keys: over all rows up to this one, or strictly before it.

    A window runs inside each bin of the first order column, and a table with one row for each bin carries its outcome on, so
    a contig is the work of as many tasks as it has bins.
    """
    binned = df.withColumns({"_bin": F.floor(F.col(order[0]) / BIN), "_value": value})
    own = binned.groupBy(*keys, "_bin").agg(how("_value").alias("_own"))
    carried = own.withColumn("_carry", how("_own").over(W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1))).drop("_own")
    inside = how("_value").over(W.partitionBy(*keys, "_bin").orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if before else 0))
    both = binned.join(carried, [*keys, "_bin"]).withColumn("_inside", inside)
    # sums and maxima of one or two numbers, of which either may be missing
    out = F.greatest("_inside", "_carry") if how is F.max else F.coalesce(F.col("_inside") + F.col("_carry"), "_inside", "_carry")
    return both.withColumn(name, out).drop("_bin", "_value", "_carry", "_inside")


def merge(df: DataFrame, gap: int = 1, keys: tuple[str, ...] = ("contig",)) -> DataFrame:
    """Sort and merge: intervals join while start <= running end + gap.

    gap=1 merges abutting inclusive intervals, gap=0 only overlapping ones; on half-open
    intervals gap=0 merges bookended ones. Gaps-and-islands, with equal intervals folded first so that the order is total.
    """
    rows = df.select(*keys, "start", "end").distinct()
    ends = running(rows, keys, ("start", "end"), F.col("end"), F.max, "_before", before=True)
    new = F.coalesce((F.col("start") > F.col("_before") + F.lit(gap)).cast("int"), F.lit(1))
    numbered = running(ends, keys, ("start", "end"), new, F.sum, "_island")
    return numbered.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def pad_clamp(df: DataFrame, contigs: DataFrame, pad: int) -> DataFrame:
    """Widen by `pad` on both sides, inside 1..length; contigs (contig, length) is the sequence dictionary."""
    joined = df.join(contigs.select("contig", "length"), "contig")
    return joined.withColumns({"start": F.greatest(F.lit(1), F.col("start") - pad), "end": F.least(F.col("length"), F.col("end") + pad)}).drop("length")


def intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Overlaps of two lists of merged intervals."""
    pairs = overlap_join(left.select("contig", "start", "end"), right.select("contig", "start", "end"))
    return pairs.select("contig", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"))


def with_prefix(df: DataFrame, order: str = "contig") -> DataFrame:
    """Adds length and its running sum in genome order, from sums of each contig and a window inside it: no global sort."""
    sized = df.withColumn("len", F.col("end") - F.col("start") + 1)
    totals = sized.groupBy(order).agg(F.sum("len").alias("own"))
    # one row for each contig: a table as small as the sequence dictionary
    before = totals.withColumn("before", F.coalesce(F.sum("own").over(W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return running(sized, (order,), ("start", "end"), F.col("len"), F.sum, "_sum").join(before.select(order, "before"), order).withColumn("prefix", F.col("before") + F.col("_sum")).drop("_sum", "before")


def scatter(df: DataFrame, n: int, filled: bool = True) -> DataFrame:
    """Adds shard 0..n-1: whole intervals in genome order, cut where the running length is nearest to total * i / n.

    The i-th target is floor((total * i + n // 2) / n); of two cuts as near the earlier wins. filled: each shard gets an interval, so there are
    as many shards as intervals at most; else there are always n, and those between equal cuts stay empty.
    """
    rows = running(with_prefix(df), ("contig",), ("start", "end"), F.lit(1), F.sum, "_k")
    counts = df.groupBy("contig").agg(F.count("*").alias("c"))
    first = counts.withColumn("skip", F.coalesce(F.sum("c").over(W.orderBy("contig").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(first.select("contig", "skip"), "contig").withColumn("rank", F.col("_k") + F.col("skip")).drop("skip", "_k")
    size = rows.agg(F.sum("len").alias("total"), F.count("*").alias("k")).first()
    n = min(n, size["k"]) if filled else n
    if n <= 1 or not size["k"]:
        return rows.withColumn("shard", F.lit(0))
    targets = [(size["total"] * i + n // 2) // n for i in range(1, n)]
    # the candidates around each target: the last prefix below it and the first not below it, found in one pass
    near = []
    for i, t in enumerate(targets):
        below, above = F.max(F.when(F.col("prefix") < t, F.struct("prefix", "rank"))), F.min(F.when(F.col("prefix") >= t, F.struct("prefix", "rank")))
        near += [below.alias(f"b{i}"), above.alias(f"a{i}")]
    found, cuts, last = rows.agg(*near).first(), [], 0
    for i, t in enumerate(targets):
        lo, hi = found[f"b{i}"], found[f"a{i}"]
        best = lo if lo is not None and (hi is None or t - lo["prefix"] <= hi["prefix"] - t) else hi
        last = min(max(best["rank"], last + 1), size["k"] - (n - 1 - i)) if filled else best["rank"]
        cuts.append(last)
    shard = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("rank")))
    return rows.withColumn("shard", shard)


def chain(df: DataFrame, gap: int, keys: tuple[str, ...] = ("contig",)) -> DataFrame:
    """Positions (keys, pos) -> regions: a position joins while it is at most `gap` beyond the one before. Adds n_loci, which counts positions."""
    rows = df.select(*keys, "pos").distinct()
    last = running(rows, keys, ("pos",), F.col("pos"), F.max, "_last", before=True)
    new = F.coalesce((F.col("pos") > F.col("_last") + gap).cast("int"), F.lit(1))
    numbered = running(last, keys, ("pos",), new, F.sum, "_region")
    return numbered.groupBy(*keys, "_region").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.count("*").alias("n_loci")).drop("_region")


def coalesce_windows(df: DataFrame, gap: int = 1000, longest: int = 2_000_000) -> DataFrame:
    """Fetch windows (contig, start, end): joined in order while the gap is at most `gap` and the whole no longer than `longest`.

    Windows that small gaps connect form clusters; a cluster that is short enough is one window, and only longer ones are walked, each on its own.
    """
    clusters = merge(df, gap + 1)
    whole = F.col("end") - F.col("start") + 1 <= longest
    parts = overlap_join(df.select("contig", "start", "end").distinct(), clusters.where(~whole), 1 << 16).select("contig", "start", "end", F.col("r_start").alias("cluster"))

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[list[int]] = []
        for start, end in rows.sort_values(["start", "end"])[["start", "end"]].itertuples(index=False):
            if out and start <= out[-1][1] + gap + 1 and max(end, out[-1][1]) - out[-1][0] + 1 <= longest:
                out[-1][1] = max(end, out[-1][1])
            else:
                out.append([start, end])
        return pd.DataFrame([(key[0], *x) for x in out], columns=["contig", "start", "end"])

    kinds = ", ".join(f"{c} {t}" for c, t in clusters.dtypes)
    return clusters.where(whole).unionByName(parts.groupBy("contig", "cluster").applyInPandas(walk, kinds))


def candidate_intervals(sites: DataFrame, requested: DataFrame, contigs: DataFrame, pad: int = 100, when_empty: str = "error") -> DataFrame:
    """Candidate sites (contig, pos) -> padded, clamped and merged intervals inside the requested ones.

    Without any candidate the merged requested intervals are the result (when_empty="input"), no rows ("none"), or an error is raised ("error").
    """
    wanted = merge(requested)
    points = sites.select("contig", F.col("pos").alias("start"), F.col("pos").alias("end"))
    found = merge(intersect(merge(pad_clamp(points, contigs, pad)), wanted))
    if when_empty not in ("input", "none", "error"):
        raise ValueError("when_empty: input, none or error")
    if when_empty == "none":
        return found
    none = found.agg(F.count("*").alias("_n")).where("_n = 0").drop("_n")
    if when_empty == "input":
        return found.unionByName(wanted.join(none, how="left_semi"))
    kinds = dict(found.dtypes)
    return found.unionByName(none.select(*[F.raise_error(F.lit("no candidate interval is left")).cast(kinds[c]).alias(c) for c in found.columns]))

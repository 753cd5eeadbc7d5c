"""Reads that reach a few bases over the edge of a splice: a join of read spans with splices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions import cigar as C
from lociframe.functions import sequence as Q
from lociframe.operators.overlap import overlap_join


def splices(reads: DataFrame) -> DataFrame:
    """Distinct skipped spans of mapped primary or supplementary reads: contig, start and end 0-based inclusive, and the reads that hold each."""
    whole = reads.where(F.col("cigar").contains("N") & Q.flag_clear(F.col("flag"), Q.UNMAPPED | Q.SECONDARY))
    each = whole.select("contig", "pos", F.explode(C.skips(C.ops(F.col("cigar")))).alias("s"))
    return each.groupBy("contig", (F.col("pos") + F.col("s.start")).alias("start"), (F.col("pos") + F.col("s.end")).alias("end")).agg(F.count("*").alias("reads"))


def _mismatches(a: Column, b: Column) -> Column:
    letters = lambda x: F.split(F.upper(x), "")
    return F.aggregate(F.zip_with(letters(a), letters(b), lambda x, y: (x != y).cast("int")), F.lit(0), lambda n, x: n + x)


def clip_overhangs(reads: DataFrame, splices: DataFrame, longest: int = 40, most: int = 1) -> DataFrame:
    """Reads (id, flag, contig, pos, cigar, seq) with overhangs that do not fit the skipped reference soft-clipped; adds clipped.

    splices: contig, start, end, head and tail: the first and last bases of the splice, `longest` at least where it is that long.
    Spans count soft clips. On the left the read begins inside the splice and ends behind it, on the right it begins before and
    ends inside. An overhang of 1 to `longest` aligned bases, half the read's at most, does not fit if more than `most`
    or at least half of its bases differ. The left test depends on a splice's end alone and the right one on its start, so a read
    meets as many distinct edges as it has bases at most. On each side the longest clip holds; the left side is cut first, and
    the right overhang may then be half of the aligned bases that remain. Unmapped and secondary reads stay as they are; so
    do reads without a splice. Rows of one id are equal.
    """
    reads, kept = reads.withColumn("_ops", C.ops(F.col("cigar"))), reads.columns
    ops = F.col("_ops")
    first, second = F.get(ops, F.lit(0)), F.get(ops, F.lit(1))
    lead = F.when(first["op"] == "S", first["len"]).when((first["op"] == "H") & (second["op"] == "S"), second["len"]).otherwise(0)
    able = F.coalesce(Q.flag_clear(F.col("flag"), Q.UNMAPPED | Q.SECONDARY) & (F.size(ops) > 0), F.lit(False))
    aligned = F.aggregate(F.filter(ops, lambda x: x["op"].isin(*"MI=X")), F.lit(0), lambda n, x: n + x["len"])
    soft = F.aggregate(F.filter(ops, lambda x: x["op"].isin(*"MDN=XS")), F.lit(0), lambda n, x: n + x["len"])
    spans = reads.where(able).select(
        "id", "contig", "pos", F.col("seq"), lead.alias("lead"), aligned.alias("aligned"), (F.col("pos") + C.reference_length(ops)).alias("stop"),
        (F.col("pos") - lead).alias("start"), (F.col("pos") - lead + soft - 1).alias("end"),
    )
    # one row an edge, with the farthest splice that ends or starts there
    ends = splices.groupBy("contig", "end").agg(F.min_by("tail", "start").alias("bases"), F.min("start").alias("other"))
    starts = splices.groupBy("contig", "start").agg(F.max_by("head", "end").alias("bases"), F.max("end").alias("other"))
    edges = ends.select("contig", F.col("end").alias("start"), "end", "bases", "other", F.lit(True).alias("left")).unionByName(starts.select("contig", "start", F.col("start").alias("end"), "bases", "other", F.lit(False).alias("left")))
    met = overlap_join(spans.distinct(), edges, size=128)
    left, edge = F.col("r_left"), F.col("r_start")
    beyond = F.when(left, (F.col("r_other") < F.col("start")) & (F.col("end") > edge)).otherwise((F.col("r_other") > F.col("end")) & (F.col("start") < edge))
    span = F.when(left, edge - F.col("pos") + 1).otherwise(F.col("stop") - edge).cast("int")
    clip = F.when(left, edge - F.col("start") + 1).otherwise(F.col("end") - edge + 1).cast("int")
    near = met.where(beyond).withColumns({"span": span, "clip": clip})
    near = near.where(F.col("span").between(1, longest) & (F.col("span") <= F.floor(F.col("aligned") / 2)) & (F.col("clip") <= F.length("seq")) & (F.col("span") <= F.length("r_bases")))
    own = F.when(left, F.substring("seq", F.col("lead") + 1, F.col("span"))).otherwise(F.substring("seq", F.length("seq") - F.col("clip") + 1, F.col("span")))
    ref = F.when(left, F.expr("right(r_bases, span)")).otherwise(F.expr("left(r_bases, span)"))
    tested = near.withColumn("wrong", _mismatches(own, ref)).where((F.length(own) == F.col("span")) & ((F.col("wrong") > most) | (F.col("wrong") >= F.ceil(F.col("span") / 2))))
    # at most `longest` right edges a read
    cuts = tested.groupBy("id").agg(F.max(F.when(left, F.col("clip"))).alias("_l"), F.collect_set(F.when(~left, F.struct("clip", "span"))).alias("_right"), F.first("aligned").alias("_n"), F.first("lead").alias("_lead"))
    remain = F.col("_n") - F.coalesce(F.col("_l") - F.col("_lead"), F.lit(0))
    cuts = cuts.select("id", "_l", F.array_max(F.filter("_right", lambda x: 2 * x["span"] <= remain))["clip"].alias("_r"))
    rows = reads.join(cuts, "id", "left")
    after = F.when(F.col("_l").isNotNull(), C.clipped_left(ops, F.col("_l"))).otherwise(F.struct(ops.alias("ops"), F.lit(0).alias("moved")))
    rows = rows.withColumn("_a", after)
    final = F.when(F.col("_r").isNotNull(), F.reverse(C.clipped_left(F.reverse(F.col("_a.ops")), F.col("_r"))["ops"])).otherwise(F.col("_a.ops"))
    hit = F.col("_l").isNotNull() | F.col("_r").isNotNull()
    changed = rows.withColumns({"pos": F.col("pos") + F.col("_a.moved"), "cigar": F.when(hit, C.text(final)).otherwise(F.col("cigar")), "clipped": hit})
    return changed.select(*kept, "clipped")

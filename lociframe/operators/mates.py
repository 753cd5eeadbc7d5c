"""Mate fields and supplementary tags of split and clipped records.

Records have tags (map), mate_pos 0-based, flag, qname and ordinal, the place in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions import cigar as C
from lociframe.functions import sequence as Q
from lociframe.functions.sequence import let


def changed_mates(clipped: DataFrame) -> DataFrame:
    """What clipping changed for a record's mate: qname, first (whether the mate is the first of its pair), mate_pos (the old start) -> new_pos, new_cigar.

    clipped: records after clipping with old_pos. Secondary ones tell nothing; of records with equal keys the last by ordinal does.
    """
    rows = clipped.where(Q.flag_clear(F.col("flag"), Q.SECONDARY)).select("qname", Q.flag_clear(F.col("flag"), Q.FIRST).alias("first"), F.col("old_pos").alias("mate_pos"), F.struct("pos", "cigar").alias("new"), "ordinal")
    last = rows.groupBy("qname", "first", "mate_pos").agg(F.max_by("new", "ordinal").alias("new"))
    return last.select("qname", "first", "mate_pos", F.col("new.pos").alias("new_pos"), F.col("new.cigar").alias("new_cigar"))


def repair_mates(records: DataFrame, changes: DataFrame) -> DataFrame:
    """Records with the start of a changed mate, and its CIGAR where they have an MC tag.

    An equi join on the name, the place in the pair and the mate's old start. Unpaired and unmapped records, and those whose mate did not change, stay.
    """
    may = Q.flag_set(F.col("flag"), Q.PAIRED) & Q.flag_clear(F.col("flag"), Q.UNMAPPED)
    new = changes.select(F.col("qname").alias("_q"), F.col("first").alias("_f"), F.col("mate_pos").alias("_m"), "new_pos", "new_cigar")
    on = (F.col("qname") == F.col("_q")) & (Q.flag_set(F.col("flag"), Q.FIRST) == F.col("_f")) & (F.col("mate_pos") == F.col("_m")) & may
    both = records.join(new, on, "left")
    tags = F.when(F.col("new_pos").isNotNull() & F.map_contains_key("tags", F.lit("MC")), F.transform_values("tags", lambda k, v: F.when(k == "MC", F.col("new_cigar")).otherwise(v))).otherwise(F.col("tags"))
    return both.withColumns({"mate_pos": F.coalesce("new_pos", "mate_pos"), "tags": tags}).select(*records.columns)


def split_mate_cigar(tags: Column) -> Column:
    """Tags whose MC is that of the mate's first section, as the mate is split too."""
    return F.transform_values(tags, lambda k, v: F.when((k == "MC") & v.contains("N"), C.sections(v)[0]["cigar"]).otherwise(v))


def supplementary_tags(parts: Column, contig: Column, pos: Column, reverse: Column, mapq: Column, nm: Column, own: Column) -> Column:
    """SA text of each of a split record's parts (array<struct<cigar,offset>>), null for a record that is whole and has none.

    An entry is contig, start, strand, CIGAR, quality and NM (* where the tag is gone). A part lists the first part ahead of what the tag
    held before (own), then all others in order.
    """
    strand, told = F.when(reverse, "-").otherwise("+"), F.coalesce(nm, F.lit("*"))
    entry = lambda p: F.concat(F.concat_ws(",", F.coalesce(contig, F.lit("*")), (pos + p["offset"] + 1).cast("string"), strand, p["cigar"], mapq.cast("string"), told), F.lit(";"))
    before = F.coalesce(own, F.lit(""))

    def texts(entries: Column) -> Column:
        def one(e: Column, i: Column) -> Column:
            others = F.filter(entries, lambda x, j: (j != i) & ((i == 0) | (j > 0)))
            return F.nullif(F.concat(F.when(i > 0, entries[0]).otherwise(""), before, F.array_join(others, "")), F.lit(""))

        return F.when(F.size(entries) > 1, F.transform(entries, one)).otherwise(F.array(F.nullif(before, F.lit(""))))

    return let(F.transform(parts, entry), texts)


def split_with_tags(reads: DataFrame) -> DataFrame:
    """reads.split_reads() with supplementary tags and mate CIGARs repaired: adds SA to the parts of a split record and cuts MC to the mate's first section.

    mapq 255 counts as 60 in entries, as the parts have it.
    """
    can = F.col("cigar").contains("N") & Q.flag_clear(F.col("flag"), Q.UNMAPPED | Q.SECONDARY)
    plan = F.when(can, C.sections(F.col("cigar"))).otherwise(F.array(F.struct(F.col("cigar"), F.lit(0).alias("offset"))))
    tag = lambda t: F.try_element_at("tags", F.lit(t))
    mapq = F.when(F.col("mapq") == 255, 60).otherwise(F.col("mapq"))
    rows = reads.withColumn("_plan", plan)
    rows = rows.withColumn("_sa", F.when(F.size("_plan") > 1, supplementary_tags(F.col("_plan"), F.col("contig"), F.col("pos"), Q.flag_set(F.col("flag"), Q.REVERSE), mapq, F.lit(None).cast("string"), tag("SA"))))
    parts = rows.select("*", F.posexplode("_plan").alias("_k", "_p"))
    cut = F.size("_plan") > 1
    kept = F.map_filter(split_mate_cigar(F.col("tags")), lambda k, v: ~k.isin("NM", "MD", "NH", "SA"))
    changed = {
        "pos": F.col("pos") + F.col("_p.offset"), "cigar": F.col("_p.cigar"), "mapq": mapq,
        "flag": F.when(F.col("_k") > 0, F.col("flag").bitwiseOR(F.lit(Q.SUPPLEMENTARY))).otherwise(F.col("flag")),
        "tags": F.when(cut, F.map_concat(kept, F.create_map(F.lit("SA"), F.get("_sa", F.col("_k"))))).otherwise(F.col("tags")),
    }
    return parts.withColumns(changed).select(*reads.columns)

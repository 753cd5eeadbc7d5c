"""Reports whose lines depend on what came before: genotyper debug text and assembly states, as tables.

Lines come with offsets (`blocks.read_lines`). What a reader would hold in variables (the region, the stage, the event, whether a header is due) is here
the last line of some kind before each line: `ordered.last_marks`, a few passes of windows over bins of offsets. Lines that
no rule takes are dropped; a blank line ends what was begun.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.ordered import last_marks
from lociframe.session import settled

KEYS = ("path",)
#: Fixed texts of the reports.
REGION, RAW, NORMALIZED, EVENT, ALLELE = r"^(?:calling for region|assemblyRegion): (.*)$", "Read-allele matrix:", "Normalized Read-Allele matrix:", r"^Event at: (.*)$", r"^Allele: (.*)$"
META = r"^\[*([^\s-]*)-(\S*?)\]*\s+k=(\S*)\s+\S+\s+(\S+)\s+(\S+)"
READ = r"^read (\d+): (.*?) cigar: (.*?) mapQ: (.*?) loc: (.*?) unclippedloc: (.*?)(?: length:(.*))?$"
ROW = r"^read: +(\d+)\s+(\S+)\s*(.*)$"


def _lines(lines: DataFrame) -> DataFrame:
    return lines.select("path", "offset", F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("t"))


def _group(t: Column, pattern: str, k: int) -> Column:
    """The group where the pattern fits, else null."""
    return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, k))


def between(t: Column, start: str, end: str) -> Column:
    """Text behind the first start and before the first end after it; empty if either is missing."""
    rest = F.substring(t, F.instr(t, F.lit(start)) + len(start), F.length(t))
    return F.when((F.instr(t, F.lit(start)) > 0) & (F.instr(rest, F.lit(end)) > 0), F.substring_index(rest, end, 1)).otherwise("")


def assembly_state(lines: DataFrame) -> dict[str, DataFrame]:
    """Three tables: regions (region, metric, value), reads (region, read, flags), haplotypes (region, haplotype, bases)."""
    t = F.col("t")
    interval, n_reads, n_haps = t.rlike(r"^[^: ]*:[^ ]*-[^ ]*$"), _group(t, r"^Number of reads in region: \s*(\S+)", 1), _group(t, r"^There were \s*(\S+)", 1)
    head = (t == "") | interval | n_reads.isNotNull() | n_haps.isNotNull()
    part = F.when((t == "") | interval, "").when(n_reads.isNotNull(), "reads").when(n_haps.isNotNull(), "haplotypes")
    rows = last_marks(_lines(lines), KEYS, "offset", {"region": F.when((t != "") & interval, t), "part": part})
    rows = rows.withColumn("region", F.coalesce("region", F.lit("")))
    counts = rows.where((t != "") & ~interval & (n_reads.isNotNull() | n_haps.isNotNull()))
    body, words = rows.where(~head), F.split(t, r"\s+")
    number = F.row_number().over(W.partitionBy("path", "part_at").orderBy("offset")) - 1  # of one region's haplotypes
    return {
        "regions": counts.select("region", F.when(n_reads.isNotNull(), "reads").otherwise("haplotypes").alias("metric"), F.coalesce(n_reads, n_haps).alias("value")),
        "reads": body.where((F.col("part") == "reads") & (F.size(words) >= 2)).select("region", words[0].alias("read"), words[1].alias("flags")),
        "haplotypes": body.where("part = 'haplotypes'").select("region", number.alias("haplotype"), t.alias("bases")),
    }


def _marked(rows: DataFrame, marks: dict[str, Column], before: bool = False) -> DataFrame:
    """last_marks(), settled: each pass reads its rows twice, so passes that build on each other would double the work each time."""
    return settled(last_marks(rows, KEYS, "offset", marks, before))


def genotyper(lines: DataFrame) -> dict[str, DataFrame]:
    """Six tables: haplotypes, pairhmm, read_qualities, events, event_alleles, allele_likelihoods; all cells but numbers of place are text."""
    t, blank = F.col("t"), F.col("t") == ""
    region = _group(t, REGION, 1)
    stage = F.when(t.startswith("Unclipped Haplotypes("), "unclipped").when(t.startswith("Clipped Haplot"), "clipped")
    rows = _marked(_lines(lines), {"region": region, "stage": stage}).withColumn("region", F.coalesce("region", F.lit("")))
    meta = F.col("stage").isNotNull() & t.startswith("[") & t.contains(" k=") & stage.isNull()
    kind = F.when(blank, "blank").when(region.isNotNull(), "region").when(stage.isNotNull(), "stage").when(meta, "meta")
    rows = rows.withColumn("kind", kind)

    # a line right behind a haplotype's description holds its bases
    told = F.when(F.col("kind").eqNullSafe("region"), F.lit(None)).otherwise(F.when(F.col("kind").eqNullSafe("meta") & t.rlike(META), t).otherwise(""))
    rows = _marked(rows, {"meta": told}, before=True)
    kind = F.when(F.col("kind").isNull() & (F.coalesce("meta", F.lit("")) != ""), "bases").when(F.col("kind").isNull() & t.rlike(EVENT), "event").when(F.col("kind").isNull() & t.rlike(ALLELE), "allele")
    kind = F.coalesce("kind", kind, F.when(t.isin(RAW, NORMALIZED), "matrix"))
    rows = rows.withColumn("kind", F.coalesce(kind, F.lit("other")))

    # the first other line behind a matrix title names its alleles
    title = F.when(F.col("kind") == "matrix", F.when(t == RAW, "raw").otherwise("normalized")).when(F.col("kind").isin("blank", "event", "other"), "")
    rows = _marked(rows, {"title": title}, before=True)
    rows = _marked(rows, {"event": F.when(F.col("kind") == "event", _event(_group(t, EVENT, 1))["id"])})
    rows = rows.withColumn("kind", F.when((F.col("kind") == "other") & (F.coalesce("title", F.lit("")) != ""), "names").otherwise(F.col("kind")))
    state = F.when(F.col("kind") == "names", F.struct(F.col("title").alias("mode"), F.split(t, r"\s+").alias("names"))).when(F.col("kind").isin("blank", "event", "matrix") | ((F.col("kind") == "other") & ~t.rlike(ROW)), F.struct(F.lit("").alias("mode"), F.array().cast("array<string>").alias("names")))
    rows = _marked(rows, {"matrix": state}, before=True)
    rows = rows.withColumn("kind", F.when((F.col("kind") == "other") & t.rlike(ROW) & (F.coalesce("matrix.mode", F.lit("")) != ""), "row").when((F.col("kind") == "other") & t.startswith("read ") & t.contains(" cigar: "), "read").otherwise(F.col("kind")))

    # the next other line behind a read holds its qualities or scores
    rows = _marked(rows, {"read": F.when(F.col("kind") == "read", F.when(t.rlike(READ), t).otherwise("")).when(F.col("kind").isin("blank", "other"), "")}, before=True)
    return _tables(rows)


def _event(raw: Column) -> Column:
    locus, kind, alleles = between(raw, "@ ", " Q."), between(raw, "type=", " alleles="), between(raw, "alleles=[", "]")
    has = F.instr(locus, F.lit(":")) > 0
    chrom, pos = F.when(has, F.substring_index(locus, ":", 1)).otherwise(""), F.when(has, F.substring(locus, F.instr(locus, F.lit(":")) + 1, F.length(locus))).otherwise("")
    return F.struct(F.concat_ws(":", chrom, pos, kind, F.replace(alleles, F.lit(" "), F.lit(""))).alias("id"), chrom.alias("chrom"), pos.alias("pos"), kind.alias("type"), alleles.alias("alleles"))


def _tables(rows: DataFrame) -> dict[str, DataFrame]:
    t, of = F.col("t"), lambda kind: rows.where(F.col("kind") == kind)
    m = lambda k: F.regexp_extract("meta", META, k)
    r = lambda k: F.regexp_extract("read", READ, k)
    number = F.row_number().over(W.partitionBy("path", "stage_at").orderBy("offset")) - 1  # of one region's haplotypes
    behind = of("other").where(F.coalesce("read", F.lit("")) != "")
    told = [r(2).alias("read"), r(1).cast("long").alias("read_index"), r(3).alias("cigar"), r(4).alias("mapq"), r(5).alias("loc"), r(6).alias("unclipped_loc"), r(7).alias("length")]
    scores = F.posexplode(F.filter(F.split(t, ","), lambda x: x != "")).alias("haplotype", "score")
    e = _event(_group(t, EVENT, 1))
    allele = F.regexp_extract(t, ALLELE, 1)
    x = lambda k: F.regexp_extract("t", ROW, k)
    cells = of("row").select("region", "event", F.col("matrix.mode").alias("matrix"), F.col("matrix.names").alias("names"), x(2).alias("read"), x(1).cast("long").alias("read_index"), F.posexplode(F.filter(F.split(x(3), r"\s+"), lambda s: s != "")).alias("k", "score"))
    return {
        "haplotypes": of("bases").select("region", "stage", number.alias("haplotype"), m(1).alias("span_start"), m(2).alias("span_end"), m(3).alias("kmer"), m(4).alias("length"), F.regexp_replace(m(5), "(ref)+$", "").alias("cigar"), m(5).endswith("ref").alias("is_ref"), t.alias("bases")),
        "pairhmm": behind.where(t.startswith(",")).select("region", *told, scores),
        "read_qualities": behind.where(t.startswith("[")).select("region", *told, t.alias("qualities")),
        "events": of("event").select("region", e["id"].alias("event"), *(e[c].alias(c) for c in ("chrom", "pos", "type", "alleles")), _group(t, EVENT, 1).alias("raw")),
        "event_alleles": of("allele").where("event is not null").select("region", "event", F.substring_index(allele, " Haps: ", 1).alias("allele"), F.when(allele.contains(" Haps: "), F.regexp_extract(allele, r"^.*? Haps: (.*)$", 1)).otherwise("").alias("haplotypes")),
        "allele_likelihoods": cells.select("region", F.coalesce("event", F.lit("")).alias("event"), "matrix", "read", "read_index", F.coalesce(F.get("names", F.col("k")), F.col("k").cast("string")).alias("allele"), "score"),
    }

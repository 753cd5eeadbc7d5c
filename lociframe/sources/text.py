"""Text formats as typed tables, and back. Gzip by file ending as Spark reads it.

Lines that a format forbids raise an error that names the line, unless `strict` is off, which drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.variants import parse_vcf
from lociframe.sources.blocks import read_lines


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.trim("value") != "")


def _checked(df: DataFrame, ok: Column, what: str, strict: bool) -> DataFrame:
    if not strict:
        return df.where(F.coalesce(ok, F.lit(False)))
    return df.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), "value")).cast("boolean")))


def contigs(spark: SparkSession, path: str) -> DataFrame:
    """Sequence dictionary: contig, contig_idx by order in the file, length."""
    rows = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_n")).where(F.col("value").startswith("@SQ"))
    name, length = F.regexp_extract("value", r"\tSN:([^\t]+)", 1), F.regexp_extract("value", r"\tLN:(\d+)", 1)
    good = _checked(rows, (name != "") & (length != "") & (length.try_cast("long") > 0), "bad @SQ line", True)
    # a dictionary has as many rows as the genome has contigs
    return good.select(name.alias("contig"), (F.row_number().over(W.orderBy("_n")) - 1).alias("contig_idx"), length.cast("long").alias("length"))


def bed(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """BED as 1-based inclusive intervals."""
    rows = _lines(spark, path).where(~F.col("value").rlike(r"^(#|track |browser )")).withColumn("f", F.split(F.trim("value"), r"\s+"))
    start, end = F.get("f", F.lit(1)).try_cast("long"), F.get("f", F.lit(2)).try_cast("long")
    return _checked(rows, (F.size("f") >= 3) & (start >= 0) & (end > start), "bad BED line", strict).select(F.col("f")[0].alias("contig"), (start + 1).alias("start"), end.alias("end"))


def interval_list(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    rows = _lines(spark, path).where(~F.col("value").startswith("@")).withColumn("f", F.split(F.trim("value"), r"\s+"))
    start, end = F.get("f", F.lit(1)).try_cast("long"), F.get("f", F.lit(2)).try_cast("long")
    return _checked(rows, (F.size("f") >= 3) & (start >= 1) & (end >= start), "bad interval line", strict).select(F.col("f")[0].alias("contig"), start.alias("start"), end.alias("end"))


def within_dictionary(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Adds contig_idx; an unknown contig or an end beyond its contig is an error."""
    j = df.join(dictionary, "contig", "left")
    ok = F.col("length").isNotNull() & (F.col("end") <= F.col("length"))
    bad = F.concat_ws(" ", F.lit("not in the dictionary:"), "contig", F.col("start").cast("string"), F.col("end").cast("string"))
    return j.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(bad).cast("boolean"))).drop("length")


def gtf_exons(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    """Exon rows of a GTF as half-open BED rows (contig, start0, end0) on the contigs of names (contig); repeats stay."""
    f = F.split("value", "\t")
    rows = _lines(spark, path).where(~F.col("value").startswith("#")).select(f.alias("f")).where((F.size("f") >= 5) & (F.col("f")[2] == "exon"))
    return rows.select(F.col("f")[0].alias("contig"), (F.col("f")[3].cast("long") - 1).alias("start0"), F.col("f")[4].cast("long").alias("end0")).join(names.select("contig").distinct(), "contig", "left_semi")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text: qname, flag, contig, pos 0-based, mapq, cigar, mate_contig, mate_pos, tlen, seq, qual array, tags map."""
    rows = _lines(spark, path).where(~F.col("value").rlike("^@[A-Z]{2}\t")).select(F.split("value", "\t").alias("f"))
    c = lambda i: F.col("f")[i]
    qual = F.when(c(10) != "*", F.transform(F.split(c(10), ""), lambda x: F.ascii(x) - 33)).otherwise(F.array().cast("array<int>"))
    tags = F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.named_struct(F.lit("key"), F.substring(t, 1, 2), F.lit("value"), F.regexp_extract(t, "^..:.:(.*)$", 1))))
    mate = F.when(c(6) == "=", c(2)).otherwise(F.nullif(c(6), F.lit("*")))
    return rows.select(
        c(0).alias("qname"), c(1).cast("int").alias("flag"), F.nullif(c(2), F.lit("*")).alias("contig"), (c(3).cast("long") - 1).alias("pos"), c(4).cast("int").alias("mapq"), c(5).alias("cigar"),
        mate.alias("mate_contig"), (c(7).cast("long") - 1).alias("mate_pos"), c(8).cast("int").alias("tlen"), c(9).alias("seq"), qual.alias("qual"), tags.alias("tags"),
    )


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """@RG lines: rg, unit (PU, else rg), unit_idx by first appearance, library (LB, else 'Unknown Library'), sample; of repeated ids the last. No group or no id is an error.

    As many rows as the header has lines, whatever the reads.
    """
    rows = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_n")).where(F.col("value").startswith("@RG\t"))
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:([^\t]*)", 1)
    has = lambda t: F.col("value").rlike(rf"\t{t}:")
    good = _checked(rows, has("ID"), "@RG line without ID", True)
    each = good.select("_n", tag("ID").alias("rg"), F.when(has("PU"), tag("PU")).otherwise(tag("ID")).alias("unit"), F.when(has("LB"), tag("LB")).otherwise("Unknown Library").alias("library"), F.when(tag("SM") != "", tag("SM")).alias("sample"))
    first = each.withColumn("_first", F.min("_n").over(W.partitionBy("unit"))).withColumn("unit_idx", F.dense_rank().over(W.orderBy("_first")) - 1)
    last = first.withColumn("_r", F.row_number().over(W.partitionBy("rg").orderBy(F.desc("_n")))).where("_r = 1")
    return last.select("rg", "unit", "unit_idx", "library", "sample", F.col("_n").alias("ordinal"))


def sample_name(groups: DataFrame) -> str:
    """The first sample that a read group names, else SAMPLE."""
    first = groups.where("sample is not null").orderBy("ordinal").select("sample").first()
    return first[0] if first else "SAMPLE"


def with_read_group(reads: DataFrame, groups: DataFrame, strict: bool = True) -> DataFrame:
    """Adds unit and library by the RG tag. An unknown or missing group is an error, or 'Unknown Library' where strict is off."""
    rg = F.try_element_at("tags", F.lit("RG"))
    rows = reads.withColumn("_rg", rg).join(groups.select(F.col("rg").alias("_rg"), "unit", "library"), "_rg", "left")
    if strict:
        rows = rows.withColumn("unit", F.when(F.col("unit").isNotNull(), F.col("unit")).otherwise(F.raise_error(F.concat(F.lit("unknown read group: "), F.coalesce("_rg", F.lit("none"))))))
    return rows.withColumn("library", F.coalesce("library", F.lit("Unknown Library"))).drop("_rg")


def vcf(spark: SparkSession, path: str, split: int = 64 << 20) -> DataFrame:
    """A VCF file or folder, plain, gzip or block-compressed (cut into ranges), as `variants.parse_vcf` has it."""
    return parse_vcf(read_lines(spark, path, split).select("value"))


def stage_table(spark: SparkSession, path: str) -> DataFrame:
    """A stage table, all text, null and missing as '': JSON lines if the first sign of the first line that is not blank is {, else TSV with a header.

    JSON rows need no schema: columns are all keys that occur, in order of name; a nested value is its compact JSON.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    first = lines.first()
    if first is None or not first["value"].lstrip().startswith("{"):
        return spark.read.csv(path, sep="\t", header=True, inferSchema=False).fillna("")
    rows = lines.select(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"}).alias("row"))
    names = [r["k"] for r in rows.select(F.explode(F.map_keys("row")).alias("k")).distinct().orderBy("k").collect()]  # as many as columns
    return rows.select(*(F.coalesce(F.try_element_at("row", F.lit(k)), F.lit("")).alias(k) for k in names))


def write_bed(df: DataFrame, path: str) -> None:
    df.select("contig", (F.col("start") - 1).cast("string"), F.col("end").cast("string")).write.csv(path, sep="\t")


def interval_list_lines(intervals: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Lines (value) of an interval list in order: the dictionary's header, then intervals sorted by its contigs. An unknown contig is an error.

    The order is a range partitioning, so part files written from it follow one another.
    """
    head = dictionary.select(F.lit(1).alias("_k"), F.col("contig_idx").cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"), F.lit(0).cast("long").alias("_c"), F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    top = dictionary.sparkSession.range(1).select(F.lit(0).alias("_k"), F.lit(0).cast("long").alias("_a"), F.lit(0).cast("long").alias("_b"), F.lit(0).cast("long").alias("_c"), F.lit("@HD\tVN:1.6").alias("value"))
    line = F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("+"), F.lit("."))
    body = within_dictionary(intervals.select("contig", "start", "end"), dictionary).select(F.lit(2).alias("_k"), F.col("contig_idx").cast("long").alias("_a"), F.col("start").cast("long").alias("_b"), F.col("end").cast("long").alias("_c"), line.alias("value"))
    return top.unionByName(head).unionByName(body).orderBy("_k", "_a", "_b", "_c").select("value")


def write_scattered(shards: DataFrame, dictionary: DataFrame, path: str) -> None:
    """Shards (shard, contig, start, end) as interval lists, one folder each (scatter=0000, ...), in place of what the path held. The header leads each.

    Rows go to tasks by shard and are sorted there, so a shard is one file.
    """
    rows = within_dictionary(shards.select("shard", "contig", "start", "end"), dictionary)
    name = F.format_string("%04d", F.col("shard"))
    line = F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("+"), F.lit("."))
    body = rows.select(name.alias("scatter"), (F.col("contig_idx") + 1).cast("long").alias("_a"), F.col("start").cast("long").alias("_b"), F.col("end").cast("long").alias("_c"), line.alias("value"))
    head = dictionary.select(F.lit(0).cast("long").alias("_a"), F.col("contig_idx").cast("long").alias("_b"), F.lit(0).cast("long").alias("_c"), F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    # contigs times shards: neither grows with the intervals
    every = rows.select(name.alias("scatter")).distinct().join(F.broadcast(head.agg(F.collect_list(F.struct("_a", "_b", "_c", "value")).alias("_h"))), how="left").select("scatter", F.inline("_h"))
    both = body.unionByName(every).repartition("scatter").sortWithinPartitions("scatter", "_a", "_b", "_c")
    both.select("scatter", "value").write.partitionBy("scatter").mode("overwrite").text(path)


def metrics_lines(metrics: DataFrame) -> DataFrame:
    """duplication_metrics() as the lines (value) of a metrics file, libraries in order of their names; optical duplicates are not told apart."""
    names = "LIBRARY UNPAIRED_READS_EXAMINED READ_PAIRS_EXAMINED SECONDARY_OR_SUPPLEMENTARY_RDS UNMAPPED_READS UNPAIRED_READ_DUPLICATES READ_PAIR_DUPLICATES READ_PAIR_OPTICAL_DUPLICATES PERCENT_DUPLICATION ESTIMATED_LIBRARY_SIZE".split()
    cells = ["unpaired_examined", "pairs_examined", "secondary_or_supplementary", "unmapped", "unpaired_duplicates", "pair_duplicates"]
    line = F.concat_ws("\t", "library", *[F.col(c).cast("string") for c in cells], F.lit("0"), F.format_string("%.6f", "percent_duplication"), F.coalesce(F.col("library_size").cast("string"), F.lit("")))
    top = metrics.sparkSession.createDataFrame([(0, "", "## METRICS CLASS\tpicard.sam.DuplicationMetrics"), (1, "", "\t".join(names))], "_k int, _l string, value string")
    return top.unionByName(metrics.select(F.lit(2).alias("_k"), F.col("library").alias("_l"), line.alias("value"))).orderBy("_k", "_l").select("value")


def vcf_lines(calls: DataFrame) -> DataFrame:
    """Calls (chrom, pos, id, db, ref, alt, qual, genotype, depth, ref_count, alt_count, fs, pl) as VCF body lines (value)."""
    from lociframe.functions import likelihood as L
    from lociframe.functions import vcf as V

    ac = F.col("genotype")
    qd = L.quality_by_depth(F.col("qual"), F.col("depth"))
    info = F.concat(F.lit("AC="), ac.cast("string"), F.lit(";AF="), F.format_string("%.3f", ac / 2), F.lit(";AN=2;DP="), F.col("depth").cast("string"), F.when(F.col("db"), ";DB").otherwise(""), F.lit(";FS="), F.format_string("%.3f", F.abs("fs")), F.lit(";QD="), F.format_string("%.2f", qd))
    sample = F.concat_ws(":", V.gt(ac), F.concat_ws(",", F.col("ref_count").cast("string"), F.col("alt_count").cast("string")), F.col("depth").cast("string"), L.genotype_quality(F.col("pl"), ac).cast("string"), F.array_join(F.col("pl").cast("array<string>"), ","))
    return calls.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.coalesce("id", F.lit(".")), "ref", "alt", F.col("qual").cast("string"), F.lit("PASS"), info, F.lit("GT:AD:DP:GQ:PL"), sample).alias("value"))


def _regions_in_order(regions: DataFrame, value: Column) -> DataFrame:
    return regions.select("category", "chrom", "pos", "ref", "alt", value.alias("value")).orderBy("category", "chrom", "pos", "ref", "alt").select("value")


def region_manifest_lines(regions: DataFrame) -> DataFrame:
    """select_regions() as the lines (value) of a table under its header, by category and key; a missing genotype is ''."""
    names = ["category", "chrom", "start", "end", "pos", "ref", "alt", "type", "a_gt", "b_gt"]
    body = regions.withColumn("value", F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])).select(F.lit(1).alias("_k"), "category", "chrom", "pos", "ref", "alt", "value")
    top = regions.sparkSession.range(1).select(F.lit(0).alias("_k"), F.lit("\t".join(names)).alias("value"))
    return body.unionByName(top, allowMissingColumns=True).orderBy("_k", "category", "chrom", "pos", "ref", "alt").select("value")


def region_bed_lines(regions: DataFrame) -> DataFrame:
    """The same as BED lines, named category_chrom:pos:ref>alt."""
    name = F.concat("category", F.lit("_"), "chrom", F.lit(":"), F.col("pos").cast("string"), F.lit(":"), "ref", F.lit(">"), "alt")
    start = F.greatest(F.col("start") - 1, F.lit(0)).cast("string")
    return _regions_in_order(regions, F.concat_ws("\t", "chrom", start, F.col("end").cast("string"), name))


def region_interval_lines(regions: DataFrame) -> DataFrame:
    """The same as the body lines of an interval list, named by category."""
    return _regions_in_order(regions, F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.lit("+"), "category"))

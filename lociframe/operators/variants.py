"""Variants: parsing, annotation, filters, comparison of call sets and of stage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.functions import likelihood as L
from lociframe.functions import vcf as V
from lociframe.operators.overlap import overlap_join

KEY = ("chrom", "pos", "ref", "alt")


def _records(lines: DataFrame) -> DataFrame:
    """Body lines (value) with their columns f; a line of fewer than 8 columns is an error."""
    body = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).withColumn("f", F.split(F.rtrim("value"), "\t"))
    return body.withColumn("f", F.when(F.size("f") >= 8, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("fewer than 8 columns: "), "value"))))


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Text lines (value) -> one row per ALT: chrom, pos, id, ref, alt, qual, filter, info map, gt, format, sample. Header and blank lines go."""
    checked = _records(lines)
    fmt, sample = F.coalesce(F.get("f", F.lit(8)), F.lit("")), F.coalesce(F.get("f", F.lit(9)), F.lit(""))
    return checked.select(
        F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].alias("id"), F.col("f")[3].alias("ref"), F.explode(F.split(F.col("f")[4], ",")).alias("alt"),
        F.col("f")[5].alias("qual"), F.col("f")[6].alias("filter"), V.info(F.col("f")[7]).alias("info"), V.sample_value(fmt, sample, "GT").alias("gt"), fmt.alias("format"), sample.alias("sample"),
    )


def genotype_table(lines: DataFrame) -> DataFrame:
    """Text lines (value) -> one row per record, all text but pos and db: chrom, pos, ref, alt, qual, filter, gt, gq, dp, ad_ref, ad_alt, fs, qd, pl, db.

    The sample's depth comes before that of INFO; a missing field is ''.
    """
    fmt, sample = F.coalesce(F.get("f", F.lit(8)), F.lit("")), F.coalesce(F.get("f", F.lit(9)), F.lit(""))
    rows = _records(lines).select("f", V.info(F.col("f")[7]).alias("info"), fmt.alias("fmt"), sample.alias("sample"))
    of = lambda key: V.sample_value(F.col("fmt"), F.col("sample"), key)
    inf = lambda key: F.coalesce(F.try_element_at("info", F.lit(key)), F.lit(""))
    ref, alt = V.split_depths(of("AD"))
    told = F.array_contains(F.split("fmt", ":"), "DP") & (F.col("sample") != "")
    return rows.select(
        F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), *[F.col("f")[i].alias(n) for i, n in ((3, "ref"), (4, "alt"), (5, "qual"), (6, "filter"))], of("GT").alias("gt"), of("GQ").alias("gq"),
        F.when(told, of("DP")).otherwise(inf("DP")).alias("dp"), ref.alias("ad_ref"), alt.alias("ad_alt"), inf("FS").alias("fs"), inf("QD").alias("qd"), of("PL").alias("pl"), F.map_contains_key("info", F.lit("DB")).alias("db"),
    )


def last_per_key(df: DataFrame, order: str, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Of rows with equal keys the last in `order`."""
    w = W.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def compare(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = KEY) -> DataFrame:
    """Full outer join of two call sets with unique keys: keys, category, type, a_gt, b_gt, a_filter, b_filter."""
    side = lambda df, x: df.select(*keys, F.col("gt").alias(f"{x}_gt"), F.col("filter").alias(f"{x}_filter"), F.lit(True).alias(f"in_{x}"))
    both = side(a, "a").join(side(b, "b"), list(keys), "full_outer")
    category = F.when(F.col("in_a") & F.col("in_b"), "shared").when(F.col("in_a"), "a_private").otherwise("b_private")
    return both.select(*keys, category.alias("category"), V.variant_type(F.col("ref"), F.col("alt")).alias("type"), "a_gt", "b_gt", "a_filter", "b_filter")


def comparison_summary(compared: DataFrame) -> DataFrame:
    """One row: sizes, shared, private, sensitivity and precision percent, by type, genotypes that agree."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    cat, snp = F.col("category"), F.col("type") == "SNP"
    counts = compared.agg(
        n(cat != "b_private").alias("a_count"), n(cat != "a_private").alias("b_count"), n(cat == "shared").alias("shared"), n(cat == "a_private").alias("a_private"), n(cat == "b_private").alias("b_private"),
        *[n((cat == c) & (snp if t == "snp" else ~snp)).alias(f"{c}_{t}") for c in ("shared", "a_private", "b_private") for t in ("snp", "indel_or_complex")],
        n((cat == "shared") & (F.col("a_gt") == F.col("b_gt"))).alias("gt_same"), n((cat == "shared") & (F.col("a_gt") != F.col("b_gt"))).alias("gt_diff"),
    )
    return counts.withColumns({"a_sensitivity": V.percent(F.col("shared"), F.col("a_count")), "b_precision_vs_a": V.percent(F.col("shared"), F.col("b_count"))})


def dataset_summary(records: DataFrame) -> DataFrame:
    """Records, repeats included, by filter and type."""
    return records.groupBy("filter", V.variant_type(F.col("ref"), F.col("alt")).alias("type")).agg(F.count("*").alias("records"))


def select_regions(compared: DataFrame, most: int = 100, pad: int = 100, pass_only: bool = True) -> DataFrame:
    """The first `most` keys of each of seven categories with padded spans; a key can be in several categories."""
    cat, snp = F.col("category"), F.col("type") == "SNP"
    shared = cat == "shared"
    labels = F.array(
        F.when((cat == "a_private") & snp, "a_private_snp"), F.when((cat == "a_private") & ~snp, "a_private_indel"), F.when((cat == "b_private") & snp, "b_private_snp"), F.when((cat == "b_private") & ~snp, "b_private_indel"),
        F.when(shared & (F.col("a_gt") != F.col("b_gt")), "shared_gt_diff"), F.when(shared & ~snp, "shared_indel"), F.when(shared & (F.col("a_gt") == F.col("b_gt")), "shared_match"),
    )
    rows = compared
    if pass_only:
        ok = lambda x: F.coalesce(F.col(f"{x}_filter") == "PASS", F.lit(True))
        rows = rows.where(ok("a") & ok("b"))
    rows = rows.select("*", F.explode(F.array_compact(labels)).alias("picked"))
    rank = F.row_number().over(W.partitionBy("picked").orderBy(*KEY))
    longest = F.greatest(F.length("ref"), F.length("alt"))
    top = rows.withColumn("_r", rank).where(F.col("_r") <= most)
    return top.select(F.col("picked").alias("category"), "chrom", F.greatest(F.lit(1), F.col("pos") - pad).alias("start"), (F.col("pos") + longest - 1 + pad).alias("end"), "pos", "ref", "alt", "type", "a_gt", "b_gt")


def equal_within(x: Column, y: Column, tolerance: float) -> Column:
    """Equal as text, or as numbers within the tolerance."""
    a, b = x.try_cast("double"), y.try_cast("double")
    return F.coalesce(x == y, F.lit(False)) | F.coalesce((F.isnan(a) & F.isnan(b)) | (F.abs(a - b) <= tolerance), F.lit(False))


def stage_diff(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """Field by field: keys, field, a_value, b_value, status (a_only and b_only rows have field ''). All columns are text; null is ''."""
    fields = sorted({*a.columns, *b.columns} - set(keys))

    def side(df: DataFrame, x: str) -> DataFrame:
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
        return df.select(*[text(k).alias(k) for k in keys], F.create_map(*[v for c in fields for v in (F.lit(c), text(c))]).alias(f"{x}_v"))

    both = side(a, "a").join(side(b, "b"), keys, "full_outer")
    cells = F.when(F.col("a_v").isNull() | F.col("b_v").isNull(), F.array(F.lit(""))).otherwise(F.array(*[F.lit(c) for c in fields]))
    rows = both.select(*keys, "a_v", "b_v", F.explode(cells).alias("field"))
    av, bv = F.try_element_at("a_v", F.col("field")), F.try_element_at("b_v", F.col("field"))
    status = F.when(F.col("b_v").isNull(), "a_only").when(F.col("a_v").isNull(), "b_only").when(~equal_within(av, bv, tolerance), "diff")
    return rows.select(*keys, "field", F.coalesce(av, F.lit("")).alias("a_value"), F.coalesce(bv, F.lit("")).alias("b_value"), status.alias("status")).where("status is not null")


def annotate_known(calls: DataFrame, known: DataFrame) -> DataFrame:
    """Adds id and db from known (chrom, pos, id, ref, alt comma list, ordinal): the first record with equal position and REF that lists the ALT."""
    sites = known.select("chrom", "pos", "ref", F.explode(F.split("alt", ",")).alias("alt"), F.col("id").alias("known_id"), "ordinal")
    first = sites.groupBy(*KEY).agg(F.min_by("known_id", "ordinal").alias("known_id"))
    out = calls.join(first, list(KEY), "left")
    return out.withColumns({"id": F.when(F.col("known_id") != ".", F.col("known_id")), "db": F.col("known_id").isNotNull()}).drop("known_id")


def hard_filter(calls: DataFrame, window: int = 35, cluster: int = 3, max_fs: float = 30.0, min_qd: float = 2.0, size: int = 1 << 16) -> DataFrame:
    """Sets filter: FS, QD and SnpCluster (at least `cluster` variants within `window` bases), or PASS.

    Windows run inside bins of `size` bases; calls less than `window` from a bin's edge are seen by the bin beyond it too.
    """
    at = F.floor(F.col("pos") / size)
    seen = F.array_distinct(F.array(at, F.floor((F.col("pos") - window) / size), F.floor((F.col("pos") + window) / size)))
    by = W.partitionBy("chrom", "_bin").orderBy("pos", "ref", "alt")
    rows = calls.withColumn("_own", at).withColumn("_bin", F.explode(seen))
    near = [F.lead("pos", cluster - 1 - k).over(by) - F.lag("pos", k).over(by) if k else F.lead("pos", cluster - 1).over(by) - F.col("pos") for k in range(cluster - 1)]
    near.append(F.col("pos") - F.lag("pos", cluster - 1).over(by))
    clustered = F.lit(False)
    for d in near:
        clustered = clustered | F.coalesce(d < window, F.lit(False))
    rows = rows.withColumn("_clustered", clustered).where("_own = _bin")
    labels = F.array_compact(F.array(F.when(F.col("fs") > max_fs, "FS"), F.when(F.col("qd") < min_qd, "QD"), F.when(F.col("_clustered"), "SnpCluster")))
    return rows.withColumn("filter", F.when(F.size(labels) == 0, "PASS").otherwise(F.array_join(labels, ";"))).drop("_own", "_bin", "_clustered")


def good_set(genotypes: DataFrame, min_depth: int = 10, min_alt: int = 3) -> DataFrame:
    """Rows (filter, dp, ad_alt) that pass with enough reads in all and for the alternative."""
    return genotypes.where((F.col("filter") == "PASS") & (F.col("dp").cast("int") >= min_depth) & (F.col("ad_alt").cast("int") >= min_alt))


def stage_summary(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float = 0.0) -> DataFrame:
    """One row over stage_diff(): rows of either side, shared keys, keys of one side, shared keys that differ, fields that differ."""
    diff = stage_diff(a, b, keys, tolerance)
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    by_key = diff.groupBy(*keys).agg(F.min("status").alias("status"), F.sum((F.col("status") == "diff").cast("long")).alias("fields"))
    out = by_key.agg(n(F.col("status") == "a_only").alias("a_private"), n(F.col("status") == "b_only").alias("b_private"), n(F.col("status") == "diff").alias("shared_with_diffs"), F.coalesce(F.sum("fields"), F.lit(0)).alias("field_diffs"))
    counts = a.agg(F.count("*").alias("a_rows")).join(b.agg(F.count("*").alias("b_rows")), how="full_outer")  # one row each
    return out.join(counts, how="full_outer").select("a_rows", "b_rows", (F.col("a_rows") - F.col("a_private")).alias("shared"), "a_private", "b_private", "shared_with_diffs", "field_diffs")


def pileup_fallback(loci: DataFrame, min_qual: float = 0.0, least_depth: int = 10, least_alt: int = 3, quality: int = 30) -> DataFrame:
    """Calls straight from counts at active loci, every observation taken at one quality: the best SNP and the best insertion, never a deletion.

    loci: contig, pos, ref_base, depth, snp_alt_count, snp_best_alt, indel_alt_count, indel_best_alt ('INS:<bases>' or 'DEL:<n>').
    Returns contig, pos, ref, alt, depth, ref_count, alt_count, genotype, qual, pl; of repeated alleles one row.
    """
    err = F.lit(10.0 ** (-quality / 10))

    def call(alt: Column, n: Column, prior: tuple[float, float, float]) -> Column:
        rest = F.greatest(F.col("depth") - n, F.lit(0)).cast("long")
        return F.struct(alt.alias("alt"), rest.alias("ref_count"), n.cast("long").alias("alt_count"), L.genotype(L.diploid(rest, n, err), prior).alias("g"))

    bases = F.col("ref_base").isin(*"ACGT") & F.col("snp_best_alt").isin(*"ACGT")
    inserted = F.col("indel_best_alt").startswith("INS:")
    found = F.array(
        F.when((F.col("snp_alt_count") >= least_alt) & bases, call(F.col("snp_best_alt"), F.col("snp_alt_count"), L.SNP_PRIOR)),
        F.when((F.col("indel_alt_count") >= least_alt) & inserted, call(F.concat("ref_base", F.expr("substr(indel_best_alt, 5)")), F.col("indel_alt_count"), L.INDEL_PRIOR)),
    )
    rows = loci.where(F.col("depth") >= least_depth).select("contig", "pos", F.col("ref_base").alias("ref"), "depth", F.explode(F.array_compact(found)).alias("c"))
    out = rows.select("contig", "pos", "ref", "c.alt", F.col("depth").cast("long").alias("depth"), "c.ref_count", "c.alt_count", "c.g.genotype", "c.g.qual", "c.g.pl").where(F.col("qual") >= min_qual)
    return out.dropDuplicates(["contig", "pos", "ref", "alt"])


def zero_candidate_seeds(loci: DataFrame) -> DataFrame:
    """SNPs that the fallback model calls homozygous reference, at loci without indel evidence: what a region without candidates starts from."""
    return pileup_fallback(loci.where(F.coalesce("indel_alt_count", F.lit(0)) == 0)).where((F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("genotype") == 0))


def _simple(ref: str = "ref", alt: str = "alt") -> Column:
    return (F.length(ref) == 1) & (F.length(alt) == 1)


def _crowd(calls: DataFrame, others: DataFrame, window: int) -> DataFrame:
    """Rows of calls with crowd: the distinct positions of SNPs among others within the window, and own: the SNPs of others at the call's position.

    Others are one row a position before the join, so that a call meets at most 2 * window + 1 of them.
    """
    at = others.where(_simple()).select("contig", "pos", "ref", "alt").distinct().groupBy("contig", "pos").agg(F.count("*").alias("snps"))
    spots = at.select("contig", F.col("pos").alias("start"), F.col("pos").alias("end"), "snps")
    asked = calls.where(_simple()).select("contig", "pos").distinct().select("contig", (F.col("pos") - window).alias("start"), (F.col("pos") + window).alias("end"), "pos")
    met = overlap_join(asked, spots)
    own = F.col("r_start") == F.col("pos")
    near = met.groupBy("contig", "pos").agg(F.count("*").alias("crowd"), F.coalesce(F.max(F.when(own, F.col("r_snps"))), F.lit(0)).alias("own"))
    return calls.join(near, ["contig", "pos"], "left").fillna(0, ["crowd", "own"])


def without_weak_snps(calls: DataFrame, kept: DataFrame, window: int = 35, weak: int = 4) -> DataFrame:
    """Supplementary calls (contig, pos, ref, alt, alt_count) but SNPs of at most `weak` alternative reads with two or more SNP positions of kept calls within the window."""
    rows = _crowd(calls, kept, window)
    return rows.where(~(_simple() & (F.col("alt_count") <= weak) & (F.col("crowd") >= 2))).select(*calls.columns)


def without_unsupported_snps(calls: DataFrame, supported: DataFrame, window: int = 35) -> DataFrame:
    """Calls but SNPs that no active locus supports (contig, pos, ref, alt) and that have two or more positions of other SNPs within the window.

    A different SNP at the call's own position counts as a position.
    """
    key = ["contig", "pos", "ref", "alt"]
    rows = _crowd(calls, calls, window).join(supported.select(*key).distinct().withColumn("_held", F.lit(True)), key, "left")
    others = F.col("crowd") - F.when(F.col("own") == 1, 1).otherwise(0)
    return rows.where(~(_simple() & F.col("_held").isNull() & (others >= 2))).select(*calls.columns)


def sort_dedup(calls: DataFrame, order: str) -> DataFrame:
    """Of calls with equal keys the one of the earliest region."""
    w = W.partitionBy(*KEY).orderBy(order)
    return calls.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

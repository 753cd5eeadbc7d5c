"""Queries on variants projected from orders and lineitem."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import likelihood as L
from lociframe.functions import vcf as V
from lociframe.operators import kmers, variants
from lociframe.plans.registry import ORACLES, query
from lociframe.session import read_table
from lociframe.sources import text as lines_of

CALLS_SQL = """
SELECT 'chr' || CAST(o_custkey % 5 AS VARCHAR) AS chrom, (o_orderkey * 37) % 200000 AS pos, substr('ACGT', CAST(1 + o_orderkey % 4 AS INTEGER), 1) AS ref, CASE WHEN o_custkey % 9 = 0 THEN 'AC' ELSE substr('CGTA', CAST(1 + o_orderkey % 4 AS INTEGER), 1) END AS alt,
  CASE o_orderstatus WHEN 'F' THEN '0/1' WHEN 'O' THEN '1/1' ELSE '0/0' END AS gt, CASE WHEN o_orderpriority LIKE '1%' THEN 'LowQual' ELSE 'PASS' END AS filter, o_orderkey AS k FROM orders"""
SIDES_SQL = f"""
WITH c AS ({CALLS_SQL}),
a AS (SELECT * FROM c WHERE k % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY k DESC) = 1),
b AS (SELECT chrom, pos, ref, alt, CASE WHEN k % 7 = 0 THEN '1/1' ELSE gt END AS gt, filter, k FROM c WHERE k % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY k DESC) = 1),
x AS (SELECT coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.pos, b.pos) AS pos, coalesce(a.ref, b.ref) AS ref, coalesce(a.alt, b.alt) AS alt,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'shared' WHEN a.k IS NOT NULL THEN 'a_private' ELSE 'b_private' END AS category,
  CASE WHEN length(coalesce(a.ref, b.ref)) = 1 AND length(coalesce(a.alt, b.alt)) = 1 THEN 'SNP' ELSE 'INDEL_OR_COMPLEX' END AS type, a.gt AS a_gt, b.gt AS b_gt, a.filter AS a_filter, b.filter AS b_filter
  FROM a FULL OUTER JOIN b ON a.chrom = b.chrom AND a.pos = b.pos AND a.ref = b.ref AND a.alt = b.alt)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    at = (1 + F.col("o_orderkey") % 4).cast("int")
    return o.select(
        F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("chrom"),
        ((F.col("o_orderkey") * 37) % 200000).alias("pos"),
        F.substr(F.lit("ACGT"), at, F.lit(1)).alias("ref"),
        F.when(F.col("o_custkey") % 9 == 0, "AC").otherwise(F.substr(F.lit("CGTA"), at, F.lit(1))).alias("alt"),
        F.when(F.col("o_orderstatus") == "F", "0/1").when(F.col("o_orderstatus") == "O", "1/1").otherwise("0/0").alias("gt"),
        F.when(F.col("o_orderpriority").startswith("1"), "LowQual").otherwise("PASS").alias("filter"),
        F.col("o_orderkey").alias("k"),
    )


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir)
    a = variants.last_per_key(c.where("k % 3 <> 0"), "k")
    b = variants.last_per_key(c.where("k % 4 <> 0").withColumn("gt", F.when(F.col("k") % 7 == 0, "1/1").otherwise(F.col("gt"))), "k")
    return variants.compare(a, b)


@query("vcf_compare", SIDES_SQL + " SELECT * FROM x")
def vcf_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir)


_N = "CAST(coalesce(sum(CASE WHEN {} THEN 1 ELSE 0 END), 0) AS BIGINT) AS {}".format


@query("vcf_compare_summary", SIDES_SQL + " SELECT " + ", ".join([
    _N("category <> 'b_private'", "a_count"), _N("category <> 'a_private'", "b_count"), *[_N(f"category = '{c}'", c) for c in ("shared", "a_private", "b_private")],
    *[_N(f"category = '{c}' AND type {op} 'SNP'", f"{c}_{t}") for c in ("shared", "a_private", "b_private") for t, op in (("snp", "="), ("indel_or_complex", "<>"))],
    _N("category = 'shared' AND a_gt = b_gt", "gt_same"), _N("category = 'shared' AND a_gt <> b_gt", "gt_diff"),
    "100.0 * sum((category = 'shared')::INT) / sum((category <> 'b_private')::INT) AS a_sensitivity", "100.0 * sum((category = 'shared')::INT) / sum((category <> 'a_private')::INT) AS b_precision_vs_a"]) + " FROM x")
def vcf_compare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.comparison_summary(compared(spark, sf_dir))


@query("vcf_set_summary", f"WITH c AS ({CALLS_SQL}) SELECT filter, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' ELSE 'INDEL_OR_COMPLEX' END AS type, count(*) AS records FROM c GROUP BY 1, 2")
def vcf_set_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.dataset_summary(calls(spark, sf_dir))


@query("region_selection", SIDES_SQL + """,
p AS (SELECT * FROM x WHERE coalesce(a_filter = 'PASS', true) AND coalesce(b_filter = 'PASS', true)),
l AS (SELECT *, unnest([CASE WHEN category <> 'shared' THEN category || CASE WHEN type = 'SNP' THEN '_snp' ELSE '_indel' END END, CASE WHEN category = 'shared' AND a_gt <> b_gt THEN 'shared_gt_diff' END,
  CASE WHEN category = 'shared' AND type <> 'SNP' THEN 'shared_indel' END, CASE WHEN category = 'shared' AND a_gt = b_gt THEN 'shared_match' END]) AS picked FROM p)
SELECT picked AS category, chrom, greatest(1, pos - 100) AS start, pos + greatest(length(ref), length(alt)) - 1 + 100 AS "end", pos, ref, alt, type, a_gt, b_gt FROM l WHERE picked IS NOT NULL QUALIFY row_number() OVER (PARTITION BY picked ORDER BY chrom, pos, ref, alt) <= 100""")
def region_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.select_regions(compared(spark, sf_dir))


@query("region_files", f"""
WITH r AS ({ORACLES["region_selection"]})
SELECT 'manifest' AS file, concat_ws(chr(9), category, chrom, CAST("start" AS VARCHAR), CAST("end" AS VARCHAR), CAST(pos AS VARCHAR), ref, alt, type, coalesce(a_gt, ''), coalesce(b_gt, '')) AS value FROM r
UNION ALL SELECT 'manifest', concat_ws(chr(9), 'category', 'chrom', 'start', 'end', 'pos', 'ref', 'alt', 'type', 'a_gt', 'b_gt')
UNION ALL SELECT 'bed', concat_ws(chr(9), chrom, CAST(greatest("start" - 1, 0) AS VARCHAR), CAST("end" AS VARCHAR), category || '_' || chrom || ':' || CAST(pos AS VARCHAR) || ':' || ref || '>' || alt) FROM r
UNION ALL SELECT 'interval_list', concat_ws(chr(9), chrom, CAST("start" AS VARCHAR), CAST("end" AS VARCHAR), '+', category) FROM r""")
def region_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the three files of selected regions."""
    picked = variants.select_regions(compared(spark, sf_dir))
    files = {"manifest": lines_of.region_manifest_lines, "bed": lines_of.region_bed_lines, "interval_list": lines_of.region_interval_lines}
    return functools.reduce(DataFrame.unionAll, [lines(picked).select(F.lit(name).alias("file"), "value") for name, lines in files.items()])


@query("stage_diff", """
WITH a AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(o_orderstatus, '') AS status, CAST(o_custkey AS VARCHAR) AS cust FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, coalesce(o_orderstatus, '') AS status, CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 WHEN o_orderkey % 7 = 0 THEN o_custkey + 9 ELSE o_custkey END AS VARCHAR) AS cust FROM orders WHERE o_orderkey % 13 <> 0)
SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL OR b.id IS NULL THEN '' ELSE 'cust' END AS field, CASE WHEN a.id IS NULL OR b.id IS NULL THEN '' ELSE a.cust END AS a_value, CASE WHEN a.id IS NULL OR b.id IS NULL THEN '' ELSE b.cust END AS b_value,
  CASE WHEN b.id IS NULL THEN 'a_only' WHEN a.id IS NULL THEN 'b_only' ELSE 'diff' END AS status
FROM a FULL OUTER JOIN b ON a.id = b.id WHERE a.id IS NULL OR b.id IS NULL OR abs(CAST(a.cust AS DOUBLE) - CAST(b.cust AS DOUBLE)) > 1""")
def stage_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    a = o.where(k % 11 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("status"), c.alias("cust"))
    b = o.where(k % 13 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("status"), F.when(k % 5 == 0, c + 1).when(k % 7 == 0, c + 9).otherwise(c).alias("cust"))
    return variants.stage_diff(a, b, ["id"], 1.0)


@query("vcf_info_parse", """SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS dp, CASE WHEN l_returnflag = 'R' THEN 'true' END AS db, CAST(CAST(l_quantity AS INTEGER) % 7 AS VARCHAR) AS ad_ref, CAST(l_linenumber AS VARCHAR) || ',3' AS ad_alt, 2 AS n FROM lineitem""")
def vcf_info_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, q = read_table(spark, sf_dir, "lineitem"), F.col("l_quantity").cast("int")
    text = F.concat(F.lit("DP="), q.cast("string"), F.when(F.col("l_returnflag") == "R", ";DB").otherwise(""))
    sample = F.concat(F.lit("0/1:"), (q % 7).cast("string"), F.lit(","), F.col("l_linenumber").cast("string"), F.lit(",3"))
    info, (ref, alt) = V.info(text), V.split_depths(V.sample_value(F.lit("GT:AD"), sample, "AD"))
    return li.select("l_orderkey", "l_linenumber", F.try_element_at(info, F.lit("DP")).alias("dp"), F.try_element_at(info, F.lit("DB")).alias("db"), ref.alias("ad_ref"), alt.alias("ad_alt"), F.lit(2).alias("n"))


@query("known_site_annotation", f"""
WITH c AS ({CALLS_SQL}), s AS (SELECT 'chr' || CAST(p_size % 5 AS VARCHAR) AS chrom, (p_partkey * 37) % 200000 AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INTEGER), 1) AS ref, unnest(['AC', substr('CGTA', CAST(1 + p_partkey % 4 AS INTEGER), 1)]) AS alt, 'rs' || CAST(p_partkey AS VARCHAR) AS id, p_partkey AS ordinal FROM part),
f AS (SELECT chrom, pos, ref, alt, arg_min(id, ordinal) AS id FROM s GROUP BY ALL)
SELECT c.*, f.id, f.id IS NOT NULL AS db FROM c LEFT JOIN f USING (chrom, pos, ref, alt)""")
def known_site_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    at = (1 + F.col("p_partkey") % 4).cast("int")
    known = p.select(F.concat(F.lit("chr"), (F.col("p_size") % 5).cast("string")).alias("chrom"), ((F.col("p_partkey") * 37) % 200000).alias("pos"), F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("id"), F.substr(F.lit("ACGT"), at, F.lit(1)).alias("ref"), F.concat(F.lit("AC,"), F.substr(F.lit("CGTA"), at, F.lit(1))).alias("alt"), F.col("p_partkey").alias("ordinal"))
    return variants.annotate_known(calls(spark, sf_dir), known)


FILTER_SQL = f"""
WITH c AS (SELECT chrom, pos, ref, alt, k, (k % 400) / 10.0 AS fs, (k % 90) / 9.0 AS qd FROM ({CALLS_SQL})),
w AS (SELECT *, lead(pos, 2) OVER o - pos AS d0, lead(pos) OVER o - lag(pos) OVER o AS d1, pos - lag(pos, 2) OVER o AS d2 FROM c WINDOW o AS (PARTITION BY chrom ORDER BY pos, ref, alt))
SELECT chrom, pos, ref, alt, k, fs, qd, CASE WHEN s = '' THEN 'PASS' ELSE s END AS filter FROM (
  SELECT *, concat_ws(';', CASE WHEN fs > 30 THEN 'FS' END, CASE WHEN qd < 2 THEN 'QD' END, CASE WHEN coalesce(d0 < 35, false) OR coalesce(d1 < 35, false) OR coalesce(d2 < 35, false) THEN 'SnpCluster' END) AS s FROM w)"""


@query("hard_filter", FILTER_SQL)
def hard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir).select("chrom", "pos", "ref", "alt", "k", ((F.col("k") % 400) / 10.0).alias("fs"), ((F.col("k") % 90) / 9.0).alias("qd"))
    return variants.hard_filter(c)


@query("sort_dedup_variants", f"SELECT chrom, pos, ref, alt, min(k) AS k FROM ({CALLS_SQL}) GROUP BY chrom, pos, ref, alt")
def sort_dedup_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.sort_dedup(calls(spark, sf_dir), "k").select("chrom", "pos", "ref", "alt", "k")


MODEL_SQL = """
WITH n AS (SELECT l_partkey, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_ref, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_alt FROM lineitem GROUP BY l_partkey),
l AS (SELECT *, n_ref * log10(0.999) + n_alt * log10(0.001 / 3) AS x0, (n_ref + n_alt) * log10(0.5 * 0.999 + 0.5 * 0.001 / 3) + log10(0.001) - log10(3) AS x1, n_ref * log10(0.001 / 3) + n_alt * log10(0.999) + 2 * (log10(0.001) - log10(3)) AS x2 FROM n),
z AS (SELECT *, greatest(x0, x1, x2) AS m FROM l),
p AS (SELECT *, m + log10(pow(10, x0 - m) + pow(10, x1 - m) + pow(10, x2 - m)) AS s FROM z)
SELECT l_partkey, n_ref, n_alt, CASE WHEN x2 > x0 AND x2 > x1 THEN 2 WHEN x1 > x0 THEN 1 ELSE 0 END AS genotype,
  CAST(CASE WHEN x0 - s <= -999.9 THEN 9999 ELSE greatest(0, least(9999, round(-10 * (x0 - s)))) END AS INTEGER) AS qual,
  CAST(greatest(0, least(999, round(-10 * (x0 - m)))) AS INTEGER) AS pl0, CAST(greatest(0, least(999, round(-10 * (x1 - m)))) AS INTEGER) AS pl1, CAST(greatest(0, least(999, round(-10 * (x2 - m)))) AS INTEGER) AS pl2 FROM p"""


@query("snp_genotype_model", MODEL_SQL)
def snp_genotype_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda s: F.sum((F.col("l_linestatus") == s).cast("long"))
    counts = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(n("F").alias("n_ref"), n("O").alias("n_alt"))
    g = L.genotype(L.diploid(F.col("n_ref"), F.col("n_alt"), F.lit(0.001)), L.SNP_PRIOR)
    return counts.withColumn("g", g).select("l_partkey", "n_ref", "n_alt", "g.genotype", "g.qual", *[F.col("g.pl")[i].alias(f"pl{i}") for i in range(3)])


@query("allele_log10_sum", """
WITH e AS (SELECT label, vec_id, unnest(embedding) AS x FROM embeddings), m AS (SELECT vec_id, label, max(CAST(x AS DOUBLE)) AS top FROM e GROUP BY vec_id, label)
SELECT m.vec_id, m.label, round(top, 6) AS best, round(top + log10(sum(pow(10.0, CAST(x AS DOUBLE) - top))), 6) AS total FROM m JOIN e USING (vec_id) GROUP BY m.vec_id, m.label, top""")
def allele_log10_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "label", F.round(F.array_max(v), 6).alias("best"), F.round(L.log10_sum_exp(v), 6).alias("total"))


FISHER_SQL = """
WITH t AS (SELECT l_partkey, CAST(sum(CASE WHEN l_linestatus = 'F' AND l_linenumber % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS rf, CAST(sum(CASE WHEN l_linestatus = 'F' AND l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rr,
  CAST(sum(CASE WHEN l_linestatus = 'O' AND l_linenumber % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS af, CAST(sum(CASE WHEN l_linestatus = 'O' AND l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ar FROM lineitem GROUP BY l_partkey),
f AS (SELECT *, rf + rr + af + ar AS total FROM t),
s AS (SELECT l_partkey, rf, rr, af, ar, CASE WHEN total > 400 THEN round(rf * 200.0 / total) ELSE rf END AS a, CASE WHEN total > 400 THEN round(rr * 200.0 / total) ELSE rr END AS b, CASE WHEN total > 400 THEN round(af * 200.0 / total) ELSE af END AS c, CASE WHEN total > 400 THEN round(ar * 200.0 / total) ELSE ar END AS d FROM f),
x AS (SELECT *, unnest(range(CAST(greatest(0, a - d) AS BIGINT), CAST(least(a + b, a + c) AS BIGINT) + 1)) AS k, a + b + c + d AS n FROM s),
p AS (SELECT *, lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(n + 1) AS fixed FROM x),
h AS (SELECT *, fixed - lgamma(k + 1) - lgamma(a + b - k + 1) - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) AS logp, fixed - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1) AS seen FROM p),
v AS (SELECT l_partkey, any_value(rf) AS rf, any_value(rr) AS rr, any_value(af) AS af, any_value(ar) AS ar, least(1.0, sum(CASE WHEN logp <= seen + 1e-9 THEN exp(logp) ELSE 0 END)) AS p, any_value(a + b = 0 OR c + d = 0 OR a + c = 0 OR b + d = 0) AS flat FROM h GROUP BY l_partkey)
SELECT l_partkey, rf, rr, af, ar, round(abs(-10 * log10(CASE WHEN flat THEN 1.0 ELSE greatest(p, 1e-320) END)), 4) AS fs FROM v"""


@query("fisher_strand", FISHER_SQL)
def fisher_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strand tables of each part."""
    n = lambda s, r: F.sum(((F.col("l_linestatus") == s) & ((F.col("l_linenumber") % 2 == 0) == F.lit(r))).cast("int"))
    t = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(n("F", False).alias("rf"), n("F", True).alias("rr"), n("O", False).alias("af"), n("O", True).alias("ar"))
    return t.withColumn("fs", F.round(L.fisher_strand(F.col("rf"), F.col("rr"), F.col("af"), F.col("ar")), 4))


@query("kmer_edges", """
WITH s AS (SELECT doc_id, regexp_replace(translate(upper(text), 'EIOU', 'ACGT'), '[^ACGT]', '', 'g') AS seq FROM documents),
k AS (SELECT substr(seq, CAST(i AS INTEGER), 10) AS src, substr(seq, CAST(i AS INTEGER) + 1, 10) AS dst FROM (SELECT seq, unnest(range(1, length(seq) - 9)) AS i FROM s))
SELECT src, dst, count(*) AS multiplicity FROM k GROUP BY src, dst HAVING count(*) >= 2""")
def kmer_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.regexp_replace(F.translate(F.upper("text"), "EIOU", "ACGT"), "[^ACGT]", "")
    rows = read_table(spark, sf_dir, "documents").select(seq.alias("seq")).where(F.length("seq") >= 11)
    return kmers.edges(rows, 10).where("multiplicity >= 2")


@query("vcf_compare_pass", SIDES_SQL.replace("WHERE k % 3 <> 0", "WHERE k % 3 <> 0 AND filter = 'PASS'").replace("WHERE k % 4 <> 0", "WHERE k % 4 <> 0 AND filter = 'PASS'") + " SELECT * FROM x")
def vcf_compare_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = calls(spark, sf_dir).where("filter = 'PASS'")
    b = c.where("k % 4 <> 0").withColumn("gt", F.when(F.col("k") % 7 == 0, "1/1").otherwise(F.col("gt")))
    return variants.compare(variants.last_per_key(c.where("k % 3 <> 0"), "k"), variants.last_per_key(b, "k"))


TABLE_SQL = """
SELECT 'chr' || CAST(l_suppkey % 5 AS VARCHAR) AS chrom, l_partkey AS pos, 'A' AS ref, CASE WHEN l_linenumber = 2 THEN 'C,G' ELSE 'T' END AS alt, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qual, CASE WHEN l_returnflag = 'A' THEN 'FS' ELSE 'PASS' END AS filter,
  '0/1' AS gt, CASE WHEN l_linenumber = 3 THEN '' ELSE '40' END AS gq, CAST(CASE WHEN l_linenumber = 3 THEN CAST(l_quantity AS INTEGER) + 1 ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR) AS dp,
  CAST(CAST(l_quantity AS INTEGER) % 7 AS VARCHAR) AS ad_ref, CAST(l_linenumber AS VARCHAR) AS ad_alt, '1.5' AS fs, CASE WHEN l_returnflag = 'R' THEN '2.5' ELSE '' END AS qd, CASE WHEN l_linenumber = 3 THEN '' ELSE '9,0,9' END AS pl, l_returnflag = 'R' AS db FROM lineitem"""


def vcf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n, r = F.col("l_quantity").cast("int"), F.col("l_linenumber"), F.col("l_returnflag")
    text = lambda c: c.cast("string")
    info = F.concat(F.lit("DP="), text(q + 1), F.lit(";FS=1.5"), F.when(r == "R", ";QD=2.5;DB").otherwise(""))
    depths = F.concat(text(q % 7), F.lit(","), text(n))
    sample = F.when(n == 3, F.concat_ws(":", F.lit("0/1"), depths)).otherwise(F.concat_ws(":", F.lit("0/1"), depths, text(q), F.lit("40"), F.lit("9,0,9")))
    cells = [F.concat(F.lit("chr"), text(F.col("l_suppkey") % 5)), text(F.col("l_partkey")), F.lit("."), F.lit("A"), F.when(n == 2, "C,G").otherwise("T"), text(q), F.when(r == "A", "FS").otherwise("PASS"), info, F.when(n == 3, "GT:AD").otherwise("GT:AD:DP:GQ:PL"), sample]
    return read_table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", *cells).alias("value"))


@query("vcf_genotype_table", TABLE_SQL)
def vcf_genotype_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.genotype_table(vcf_text(spark, sf_dir))


@query("vcf_good_set", f"SELECT * FROM ({TABLE_SQL}) WHERE filter = 'PASS' AND CAST(dp AS INTEGER) >= 10 AND CAST(ad_alt AS INTEGER) >= 3")
def vcf_good_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.good_set(variants.genotype_table(vcf_text(spark, sf_dir)))


LOCI_SQL = """
SELECT l_suppkey % 3 AS contig, l_partkey AS pos, substr('ACGT', CAST(1 + l_partkey % 4 AS INTEGER), 1) AS ref_base, count(*) AS depth, CAST(sum(CASE WHEN l_linestatus = 'O' AND l_linenumber < 6 THEN 1 ELSE 0 END) AS BIGINT) AS snp_n, substr('CGTA', CAST(1 + l_partkey % 4 AS INTEGER), 1) AS snp_alt,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS indel_n, CASE WHEN l_partkey % 3 = 0 THEN 'DEL:2' ELSE 'INS:GG' END AS indel_alt FROM lineitem GROUP BY l_suppkey % 3, l_partkey"""


def _fallback_sql(prior: str) -> str:
    return f"""
  p AS (SELECT *, rest * log10(0.999) + n * log10(0.001 / 3) AS x0, depth * log10(0.5 * 0.999 + 0.5 * 0.001 / 3) + ({prior}) AS x1, rest * log10(0.001 / 3) + n * log10(0.999) + 2 * ({prior}) AS x2 FROM c)"""


def _fallback_side(alt: str, n: str, where: str, prior: str) -> str:
    return f"""SELECT contig, pos, ref_base AS ref, alt, depth, rest AS ref_count, n AS alt_count, CASE WHEN x2 > x0 AND x2 > x1 THEN 2 WHEN x1 > x0 THEN 1 ELSE 0 END AS genotype,
  CAST(CASE WHEN x0 - s <= -999.9 THEN 9999 ELSE greatest(0, least(9999, round(-10 * (x0 - s)))) END AS INTEGER) AS qual FROM (
  SELECT *, m + log10(pow(10, x0 - m) + pow(10, x1 - m) + pow(10, x2 - m)) AS s FROM (SELECT *, greatest(x0, x1, x2) AS m FROM (
  WITH c AS (SELECT contig, pos, ref_base, depth, {n} AS n, depth - {n} AS rest, {alt} AS alt FROM ({LOCI_SQL}) WHERE depth >= 10 AND {n} >= 3 AND {where}), {_fallback_sql(prior)} SELECT * FROM p)))"""


FALLBACK_SQL = _fallback_side("snp_alt", "snp_n", "true", "log10(0.001) - log10(3)") + " UNION ALL " + _fallback_side("ref_base || substr(indel_alt, 5)", "indel_n", "indel_alt LIKE 'INS:%'", "log10(1.0 / 8000)")


def loci(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, n = F.col("l_partkey"), lambda c: F.sum(c.cast("long"))
    at = (1 + part % 4).cast("int")
    counts = read_table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 3).alias("contig"), part).agg(F.count("*").alias("depth"), n((F.col("l_linestatus") == "O") & (F.col("l_linenumber") < 6)).alias("snp_alt_count"), n(F.col("l_returnflag") == "R").alias("indel_alt_count"))
    letter = lambda word: F.substr(F.lit(word), at, F.lit(1))
    return counts.select("contig", part.alias("pos"), letter("ACGT").alias("ref_base"), "depth", "snp_alt_count", letter("CGTA").alias("snp_best_alt"), "indel_alt_count", F.when(part % 3 == 0, "DEL:2").otherwise("INS:GG").alias("indel_best_alt"))


@query("pileup_fallback_calls", FALLBACK_SQL)
def pileup_fallback_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.pileup_fallback(loci(spark, sf_dir)).drop("pl")


DENSE_SQL = f"WITH c AS (SELECT CAST(right(chrom, 1) AS BIGINT) AS contig, pos, ref, alt, min(k) AS k, CAST(min(k) % 9 AS BIGINT) AS alt_count FROM ({CALLS_SQL}) GROUP BY chrom, pos, ref, alt)"


def dense_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = variants.sort_dedup(calls(spark, sf_dir), "k")
    return c.select(F.right("chrom", F.lit(1)).cast("long").alias("contig"), "pos", "ref", "alt", "k", (F.col("k") % 9).alias("alt_count"))


@query("weak_cluster_snps", DENSE_SQL + """,
e AS (SELECT DISTINCT contig, pos FROM c WHERE k % 3 = 0 AND length(ref) = 1 AND length(alt) = 1),
n AS (SELECT c.contig, c.pos, c.ref, c.alt, count(e.pos) AS crowd FROM c LEFT JOIN e ON c.contig = e.contig AND e.pos BETWEEN c.pos - 35 AND c.pos + 35 WHERE k % 3 <> 0 GROUP BY ALL)
SELECT c.* FROM c JOIN n USING (contig, pos, ref, alt) WHERE NOT (length(ref) = 1 AND length(alt) = 1 AND alt_count <= 4 AND crowd >= 2)""")
def weak_cluster_snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dense_calls(spark, sf_dir)
    return variants.without_weak_snps(c.where("k % 3 <> 0"), c.where("k % 3 = 0"))


@query("unsupported_cluster_snps", DENSE_SQL + """,
s AS (SELECT DISTINCT contig, pos, ref, alt FROM c WHERE length(ref) = 1 AND length(alt) = 1),
n AS (SELECT a.contig, a.pos, a.ref, a.alt, count(DISTINCT b.pos) AS crowd FROM s a JOIN s b ON a.contig = b.contig AND b.pos BETWEEN a.pos - 35 AND a.pos + 35 AND (a.pos, a.ref, a.alt) <> (b.pos, b.ref, b.alt) GROUP BY ALL)
SELECT c.* FROM c LEFT JOIN n USING (contig, pos, ref, alt) WHERE NOT (length(ref) = 1 AND length(alt) = 1 AND k % 4 <> 0 AND coalesce(crowd, 0) >= 2)""")
def unsupported_cluster_snps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dense_calls(spark, sf_dir)
    return variants.without_unsupported_snps(c, c.where("k % 4 = 0"))

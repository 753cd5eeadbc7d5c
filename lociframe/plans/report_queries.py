"""Queries on summary files, counters, mate repair and region statistics, projected from the given tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import sequence as Q
from lociframe.operators import mates, reads, variants
from lociframe.plans.read_queries import EVIDENCE_SQL, line_evidence
from lociframe.plans.region_queries import REGIONS_SQL
from lociframe.plans.registry import ORACLES, query
from lociframe.plans.variant_queries import SIDES_SQL, compared
from lociframe.session import read_table
from lociframe.sources import comparison as K
from lociframe.sources import debug_text

TAB = "chr(9)"


def _counts_sql(source: str) -> str:
    n = lambda c, name: f"CAST(coalesce(sum(({c})::INT), 0) AS BIGINT) AS {name}"
    out = []
    for s, a, b in (("all", "category <> 'b_private'", "category <> 'a_private'"), ("pass", "category <> 'b_private' AND coalesce(a_filter = 'PASS', false)", "category <> 'a_private' AND coalesce(b_filter = 'PASS', false)")):
        sets = {"shared": f"({a}) AND ({b})", "a_private": f"({a}) AND NOT ({b})", "b_private": f"({b}) AND NOT ({a})"}
        out += [n(a, f"{s}_a_count"), n(b, f"{s}_b_count"), *(n(c, f"{s}_{k}") for k, c in sets.items())]
        out += [n(f"{c} AND type {'=' if t == 'snp' else '<>'} 'SNP'", f"{s}_{k}_{t}") for k, c in sets.items() for t in K.KINDS]
        out += [n(f"{sets['shared']} AND coalesce(a_gt = b_gt, false)", f"{s}_gt_same"), n(f"{sets['shared']} AND coalesce(a_gt <> b_gt, false)", f"{s}_gt_diff")]
    for x, has in (("a", "category <> 'b_private'"), ("b", "category <> 'a_private'")):
        ok = f"{has} AND coalesce({x}_filter = 'PASS', false)"
        out += [n(has, f"{x}_total"), n(ok, f"{x}_pass")] + [n(f"{c} AND type {op} 'SNP'", f"{x}_{name}_{t}") for name, c in (("all", has), ("pass", ok)) for t, op in (("snp", "="), ("indel", "<>"))]
        out.append(f"(SELECT string_agg(f || ':' || k, ', ' ORDER BY f) FROM (SELECT coalesce({x}_filter, '') AS f, CAST(count(*) AS VARCHAR) AS k FROM {source} WHERE {has} GROUP BY 1)) AS {x}_filters")
    counts = f"SELECT {', '.join(out)} FROM {source}"
    share = ", ".join(f"CASE WHEN {s}_{d} = 0 THEN 0.0 ELSE 100.0 * {s}_shared / {s}_{d} END AS {s}_{c}" for s in ("all", "pass") for c, d in (("a_sensitivity", "a_count"), ("b_precision_vs_a", "b_count")))
    return f"SELECT *, {share} FROM ({counts})"


def _cells(s: str, digits: int, unit: str = "") -> list[str]:
    return [f"printf('%.{digits}f', {s}_{c}) || '{unit}'" if c in ("a_sensitivity", "b_precision_vs_a") else f"CAST({s}_{c} AS VARCHAR)" for c in K.CELLS]


def _bar(cells: list[str]) -> str:
    return "'| ' || concat_ws(' | ', " + ", ".join(cells) + ") || ' |'"


def _files_sql() -> str:
    text = lambda xs: [f"'{x}'" for x in xs]
    md = [*text(["# VCF comparison: first vs second", "", "## Counts", ""]), _bar(text(["dataset", "total allele keys", "PASS allele keys", "non-PASS allele keys", "PASS SNP", "PASS indel/complex", "all SNP", "all indel/complex", "filters"])), "'|---|' || repeat('---:|', 7) || '---|'"]
    md += [_bar([f"'{label}'", *(f"CAST({e} AS VARCHAR)" for e in (f"{x}_total", f"{x}_pass", f"{x}_total - {x}_pass", f"{x}_pass_snp", f"{x}_pass_indel", f"{x}_all_snp", f"{x}_all_indel")), f"{x}_filters"]) for x, label in (("a", "first"), ("b", "second"))]
    heads = ["set", "A count", "B count", "shared", "A private", "B private", "A sensitivity", "B precision vs A", *(f"{s} {k}" for s in ("shared", "A-private", "B-private") for k in ("SNP", "indel/complex")), "GT same", "GT diff"]
    md += [*text(["", "## Exact Allele-Key Comparison", ""]), _bar(text(heads)), f"'|---|' || repeat('---:|', {len(K.CELLS)})"]
    md += [_bar([f"'{label}'", *_cells(s, 3, "%")]) for s, label in (("all", "all allele keys"), ("pass", "PASS only"))]
    tsv = [f"concat_ws({TAB}, {', '.join(text(['set', *K.CELLS]))})", *(f"concat_ws({TAB}, '{s}', {', '.join(_cells(s, 6))})" for s in ("all", "pass"))]
    told = [(c, e) for c, e in zip(K.CELLS, range(len(K.CELLS)), strict=True) if not c.endswith(K.KINDS)]
    json = text(["{", '  "a_label": "first",', '  "b_label": "second",'])
    for s in ("all", "pass"):
        json += [f"""'  "{s}_records": {{'""", *(f"""'    "{c}": ' || {_cells(s, 6)[e]} || '{"" if c == told[-1][0] else ","}'""" for c, e in told), text(["  }," if s == "all" else "  }"])[0]]
    json.append("'}'")
    files = " UNION ALL ".join(f"SELECT '{name}' AS file, 0 AS part, CAST(unnest(range({len(lines)})) AS BIGINT) AS line, unnest([{', '.join(lines)}]) AS value FROM n" for name, lines in (("summary.md", md), ("summary.tsv", tsv), ("summary.json", json)))
    names = ["category", "chrom", "pos", "ref", "alt", "type", "a_filter", "b_filter", "a_gt", "b_gt"]
    body = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in names)
    return f"{SIDES_SQL}, n AS ({_counts_sql('x')}) {files} UNION ALL SELECT 'details.tsv', 0, 0, concat_ws({TAB}, {', '.join(text(names))}) UNION ALL SELECT 'details.tsv', 1, pos, concat_ws({TAB}, {body}) FROM x"


@query("comparison_files", _files_sql())
def comparison_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the four files of a comparison of call sets."""
    return K.comparison_files(compared(spark, sf_dir), "first", "second")


def _stage_sql() -> str:
    diff = ORACLES["stage_diff"]
    n = lambda c: f"CAST(coalesce(sum(({c})::INT), 0) AS BIGINT)"
    sums = f"SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 11 <> 0) AS a_rows, (SELECT count(*) FROM orders WHERE o_orderkey % 13 <> 0) AS b_rows, {n('''status = 'a_only' ''')} AS a_private, {n('''status = 'b_only' ''')} AS b_private, {n('''status = 'diff' ''')} AS field_diffs FROM d"
    cells = ["a_rows", "b_rows", "a_rows - a_private", "a_private", "b_private", "field_diffs", "field_diffs"]
    names = ["A rows", "B rows", "shared rows", "A-private rows", "B-private rows", "shared rows with field diffs", "field diffs"]
    md = ["'# orders stage diff'", "''", "'- key columns: `id`'", "'- numeric tolerance: `1`'", "''", "'| metric | value |'", "'|---|---:|'", *(f"'| {m} | ' || CAST({c} AS VARCHAR) || ' |'" for m, c in zip(names, cells, strict=True))]
    head = ", ".join(f"'{c}'" for c in ["stage", *K.STAGE_CELLS])
    tsv = [f"concat_ws({TAB}, {head})", f"concat_ws({TAB}, 'orders', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cells) + ")"]
    files = " UNION ALL ".join(f"SELECT '{name}' AS file, 0 AS part, CAST(unnest(range({len(lines)})) AS BIGINT) AS line, unnest([{', '.join(lines)}]) AS value FROM s" for name, lines in (("summary.md", md), ("summary.tsv", tsv)))
    kind = "CASE status WHEN 'a_only' THEN 'a_private' WHEN 'b_only' THEN 'b_private' ELSE 'field_diff' END"
    return f"WITH d AS ({diff}), s AS ({sums}) {files} UNION ALL SELECT 'details.tsv', 0, 0, concat_ws({TAB}, 'category', 'row_key', 'field', 'a_value', 'b_value') UNION ALL SELECT 'details.tsv', 1, 0, concat_ws({TAB}, {kind}, id, field, a_value, b_value) FROM d"


@query("stage_files", _stage_sql())
def stage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the three files of a stage diff."""
    o, k, c = read_table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    a = o.where(k % 11 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("status"), c.alias("cust"))
    b = o.where(k % 13 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("status"), F.when(k % 5 == 0, c + 1).when(k % 7 == 0, c + 9).otherwise(c).alias("cust"))
    return K.stage_files(variants.stage_diff(a, b, ["id"], 1.0), variants.stage_summary(a, b, ["id"], 1.0), ["id"], "orders", 1.0)


CANDIDATE = "(indel_count >= 1 OR (depth > 0 AND alt_count >= 2 AND alt_count >= depth * 0.2))"


@query("candidate_summary", f"""
WITH e AS ({EVIDENCE_SQL}), s AS (
  SELECT count(*) AS sites, CAST(sum((depth > 0)::INT) AS BIGINT) AS covered, CAST(sum(depth) AS BIGINT) AS total, max(depth) AS deepest, CAST(sum({CANDIDATE}::INT) AS BIGINT) AS hits FROM e),
g AS (SELECT count(*) AS n, CAST(sum(stop - start + 1) AS BIGINT) AS b FROM ({REGIONS_SQL})), f AS (SELECT count(*) AS n, CAST(sum(21) AS BIGINT) AS b FROM e WHERE {CANDIDATE})
SELECT unnest(['min_mapq', 'min_alt_fraction', 'clip_to_input_intervals', {", ".join(f"'{c}'" for c in K.MEASURED)}]) AS metric,
  unnest(['20', '0.200000', 'true', CAST(g.n AS VARCHAR), CAST(g.b AS VARCHAR), CAST(sites AS VARCHAR), CAST(covered AS VARCHAR), CAST(hits AS VARCHAR), printf('%.3f', total / covered), CAST(deepest AS VARCHAR), CAST(f.n AS VARCHAR), CAST(f.b AS VARCHAR), printf('%.6f', 1 - f.b / g.b), 'false']) AS value FROM s, g, f""")
def candidate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a candidate search; found intervals are the candidate sites with 10 bases on both sides."""
    sites = line_evidence(spark, sf_dir)
    hit = reads.is_candidate(F.col("depth"), F.col("alt_count"), F.col("indel_count"))
    s = F.col("s_suppkey")
    given = read_table(spark, sf_dir, "supplier").select(((s * 101) % 20000).alias("start"), ((s * 101) % 20000 + 50 + s % 200).alias("end"))
    found = sites.where(hit).select((F.col("pos") - 10).alias("start"), (F.col("pos") + 10).alias("end"))
    return K.candidate_summary(sites, given, found, hit, {"min_mapq": 20, "min_alt_fraction": 0.2, "clip_to_input_intervals": True})


@query("region_stats", f"""
WITH l AS (SELECT l_suppkey % 3 AS contig, (l_partkey * 13) % 20000 AS pos, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS depth, CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INTEGER) ELSE 0 END) AS BIGINT) AS alt_count FROM lineitem GROUP BY 1, 2),
j AS (SELECT r.*, l.pos, alt_count / depth AS share, alt_count >= 20 AS active FROM ({REGIONS_SQL}) r LEFT JOIN l ON l.contig = r.contig AND l.pos BETWEEN r.start AND r.stop)
SELECT region, contig, start, stop AS "end", count(pos) AS observed_loci, CAST(coalesce(sum(active::INT), 0) AS BIGINT) AS active_loci, round(coalesce(max(share), 0), 9) AS max_alt_fraction, round(coalesce(avg(share), 0), 9) AS mean_alt_fraction FROM j GROUP BY ALL""")
def region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, s = F.col("l_quantity").cast("int"), F.col("s_suppkey")
    loci = read_table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 3).alias("contig"), ((F.col("l_partkey") * 13) % 20000).alias("pos")).agg(F.sum(q).alias("depth"), F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(0)).alias("alt_count"))
    areas = read_table(spark, sf_dir, "supplier").select(s.alias("region"), (s % 3).alias("contig"), ((s * 101) % 20000).alias("start"), ((s * 101) % 20000 + 50 + s % 200).alias("end"))
    out = reads.region_stats(loci.withColumn("active", F.col("alt_count") >= 20), areas)
    return out.withColumns({c: F.round(c, 9) for c in ("max_alt_fraction", "mean_alt_fraction")})


# Reads with clips, insertions and skips, one for each order; orders 2k and 2k + 1 are mates.
ORDER_READS_SQL = """
SELECT o_orderkey AS read, CAST(o_custkey % 3 AS VARCHAR) AS contig, (o_custkey * 13) % 2000 AS pos, CAST(o_orderkey % 2 AS INTEGER) AS h, CAST(o_custkey % 3 AS INTEGER) AS s, CAST(5 + o_orderkey % 6 AS INTEGER) AS a, CAST(o_orderkey % 3 AS INTEGER) AS ins,
  CAST(4 + o_custkey % 5 AS INTEGER) AS c, CAST(o_custkey % 4 * 25 AS INTEGER) AS n, CAST(3 + o_orderkey % 4 AS INTEGER) AS e, o_orderstatus FROM orders"""


def paired_spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spliced reads in pairs, with mate fields and tags; a read whose mate is missing has no mate position."""
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    part = lambda x, op: F.when(x > 0, F.concat(x.cast("string"), F.lit(op))).otherwise("")
    cigar = F.concat(part(k % 2, "H"), part(u % 3, "S"), part(5 + k % 6, "M"), part(k % 3, "I"), part(4 + u % 5, "M"), part(u % 4 * 25, "N"), part(3 + k % 4, "M"))
    own = read_table(spark, sf_dir, "orders").select(k.alias("read"), F.floor(k / 2).alias("pair"), (k % 2 == 1).alias("first"), (u % 3).cast("string").alias("contig"), ((u * 13) % 2000).alias("pos"), cigar.alias("cigar"), (F.col("o_orderstatus") == "O").alias("reverse"))
    mate = own.select("pair", (~F.col("first")).alias("first"), F.col("pos").alias("mate_pos"), F.col("cigar").alias("mate_cigar"))
    rows = own.join(mate, ["pair", "first"], "left")
    flag = F.lit(Q.PAIRED) + F.when(F.col("first"), Q.FIRST).otherwise(Q.SECOND) + F.when(F.col("reverse"), Q.REVERSE).otherwise(0)
    tags = F.map_from_arrays(F.array(*map(F.lit, ("MC", "NM", "XS"))), F.array(F.col("mate_cigar"), F.lit("1"), F.lit("+")))
    return rows.select("read", F.col("pair").cast("string").alias("qname"), flag.alias("flag"), "contig", "pos", "cigar", F.when(F.col("read") % 4 == 0, 255).otherwise(40).alias("mapq"), F.coalesce("mate_pos", F.lit(-1)).alias("mate_pos"), F.when(F.col("mate_cigar").isNotNull(), tags).otherwise(F.map_filter(tags, lambda k, v: k != "MC")).alias("tags"), F.col("read").alias("ordinal"))


OPS = ["CASE WHEN h > 0 THEN CAST(h AS VARCHAR) || 'H' ELSE '' END", "CASE WHEN ins > 0 THEN CAST(ins AS VARCHAR) || 'I' ELSE '' END"]
CIGAR_SQL = f"{OPS[0]} || CASE WHEN s > 0 THEN CAST(s AS VARCHAR) || 'S' ELSE '' END || CAST(a AS VARCHAR) || 'M' || {OPS[1]} || CAST(c AS VARCHAR) || 'M' || CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || 'N' ELSE '' END || CAST(e AS VARCHAR) || 'M'"
PAIRED_SQL = f"""
WITH o AS (SELECT r.*, {CIGAR_SQL} AS cigar, read // 2 AS pair, read % 2 = 1 AS is_first FROM ({ORDER_READS_SQL}) r),
p AS (SELECT o.*, m.pos AS mate_pos, m.cigar AS mate_cigar, m.read AS mate FROM o LEFT JOIN o m ON m.pair = o.pair AND m.is_first <> o.is_first)"""


@query("mate_repair", PAIRED_SQL + """
SELECT p.read, CASE WHEN p.mate % 4 = 1 THEN p.mate_pos + 2 ELSE coalesce(p.mate_pos, -1) END AS mate_pos, CASE WHEN p.mate % 4 = 1 THEN '2S' || p.mate_cigar ELSE p.mate_cigar END AS mc FROM p""")
def mate_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth read counts as clipped, with a new start and CIGAR, and its mate learns of it."""
    rows = paired_spliced(spark, sf_dir)
    clipped = rows.where("read % 4 = 1").select("qname", "flag", F.col("pos").alias("old_pos"), (F.col("pos") + 2).alias("pos"), F.concat(F.lit("2S"), "cigar").alias("cigar"), "ordinal")
    return mates.repair_mates(rows, mates.changed_mates(clipped)).select("read", "mate_pos", F.try_element_at("tags", F.lit("MC")).alias("mc"))


_SOFT = "CASE WHEN {0} > 0 THEN CAST({0} AS VARCHAR) || 'S' ELSE '' END"
_BODY = "CASE WHEN ins > 0 THEN CAST(a AS VARCHAR) || 'M' || CAST(ins AS VARCHAR) || 'I' || CAST(c AS VARCHAR) || 'M' ELSE CAST(a + c AS VARCHAR) || 'M' END"
_FIRST = f"CASE WHEN h > 0 THEN CAST(h AS VARCHAR) || 'H' ELSE '' END || {_SOFT.format('s')} || {_BODY} || CAST(e AS VARCHAR) || 'S'"
_SECOND = f"CASE WHEN h > 0 THEN CAST(h AS VARCHAR) || 'H' ELSE '' END || {_SOFT.format('(s + a + ins + c)')} || CAST(e AS VARCHAR) || 'M'"


@query("split_tags", PAIRED_SQL + f""",
q AS (SELECT p.*, CASE WHEN n > 0 THEN {_FIRST} ELSE cigar END AS c0, CASE WHEN n > 0 THEN {_SECOND} END AS c1, CASE WHEN o_orderstatus = 'O' THEN '-' ELSE '+' END AS strand, CASE WHEN read % 4 = 0 THEN '60' ELSE '40' END AS mq FROM p),
e AS (SELECT q.*, contig || ',' || CAST(pos + 1 AS VARCHAR) || ',' || strand || ',' || c0 || ',' || mq || ',*;' AS e0, contig || ',' || CAST(pos + 1 + a + c + n AS VARCHAR) || ',' || strand || ',' || c1 || ',' || mq || ',*;' AS e1 FROM q),
m AS (SELECT e.*, o.c0 AS mate_first FROM e LEFT JOIN q o ON o.read = e.mate)
SELECT read, pos, c0 AS cigar, CASE WHEN n > 0 THEN e1 END AS sa, CASE WHEN n > 0 THEN mate_first ELSE mate_cigar END AS mc, CASE WHEN n > 0 THEN NULL ELSE '1' END AS nm FROM m
UNION ALL SELECT read, pos + a + c + n, c1, e0, mate_first, NULL FROM m WHERE n > 0""")
def split_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tag = lambda t: F.try_element_at("tags", F.lit(t))
    out = mates.split_with_tags(paired_spliced(spark, sf_dir))
    return out.select("read", "pos", "cigar", tag("SA").alias("sa"), tag("MC").alias("mc"), tag("NM").alias("nm"))


@query("split_counters", f"SELECT count(*) AS input, CAST(sum(CASE WHEN n > 0 THEN 2 ELSE 1 END) AS BIGINT) AS output, CAST(sum((n > 0)::INT) AS BIGINT) AS split, CAST(sum((read % 4 = 0)::INT) AS BIGINT) AS mapq_changed FROM ({ORDER_READS_SQL})")
def split_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that come with the split records, from one pass over them."""
    seen = Observation("split")
    reads.split_reads(paired_spliced(spark, sf_dir), seen).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[c] for c in ("input", "output", "split", "mapq_changed"))], "input long, output long, split long, mapq_changed long")


# Debug text of one block for each supplier: (line of the block, text), with the supplier's numbers in it.
BLOCK = (
    "calling for region: c{k}:{a}-{b}", "Unclipped Haplotypes(2):", "[{a}-{b}] k=10 len 50 {a}Mref", "ACGT", "[{a}-{b}] k=25 len 48 {a}M2D3M", "GGTT", "",
    "read 0: r{k} cigar: {a}M mapQ: 60 loc: c:{a} unclippedloc: c:{b} length:{a}", "[30, {a}]", "read 1: s{k} cigar: {b}M mapQ: 7 loc: c:{a} unclippedloc: c:{b} length:{b}", ",-{a}.5,-{b}.25", "",
    "Event at: [VC x @ c{k}:{a} Q. type=SNP alleles=[A*, C] z", "Allele: A* Haps: [0]", "Allele: C Haps: [{k}]", "Read-allele matrix:", "A* C", "read: 0 r{k} -{a}.0 -2.0", "read: 1 s{k} -3.0 -{b}.5", "",
    "Normalized Read-Allele matrix:", "A* C", "read: 0 r{k} 0 -{b}", "that is all",
)
FILLED = {"{k}": "s_suppkey", "{a}": "s_suppkey % 90 + 1", "{b}": "s_suppkey % 90 + 40"}


def _filled(line: str) -> list[str]:
    """The line as SQL terms to be joined."""
    out = [line]
    for mark in FILLED:
        out = [piece for x in out for piece in ([x] if x in FILLED else [y for part in x.split(mark) for y in (mark, part)][1:])]
    return [f"CAST({FILLED[x]} AS VARCHAR)" if x in FILLED else f"'{x}'" for x in out if x]


def _debug_sql() -> str:
    k, a, b = (f"CAST({FILLED[x]} AS VARCHAR)" for x in ("{k}", "{a}", "{b}"))
    region, event = f"'c' || {k} || ':' || {a} || '-' || {b}", f"'c' || {k} || ':' || {a} || ':SNP:A*,C'"
    rows = [
        ("haplotypes", ["'unclipped'", "'0'", a, b, "'10'", "'50'", f"{a} || 'M'", "'true'", "'ACGT'"]), ("haplotypes", ["'unclipped'", "'1'", a, b, "'25'", "'48'", f"{a} || 'M2D3M'", "'false'", "'GGTT'"]),
        ("read_qualities", [f"'r' || {k}", "'0'", f"{a} || 'M'", "'60'", f"'c:' || {a}", f"'c:' || {b}", a, f"'[30, ' || {a} || ']'"]),
        *(("pairhmm", [f"'s' || {k}", "'1'", f"{b} || 'M'", "'7'", f"'c:' || {a}", f"'c:' || {b}", b, f"'{i}'", s]) for i, s in enumerate((f"'-' || {a} || '.5'", f"'-' || {b} || '.25'"))),
        ("events", [event, f"'c' || {k}", a, "'SNP'", "'A*, C'", f"'[VC x @ c' || {k} || ':' || {a} || ' Q. type=SNP alleles=[A*, C] z'"]),
        ("event_alleles", [event, "'A*'", "'[0]'"]), ("event_alleles", [event, "'C'", f"'[' || {k} || ']'"]),
        *(("allele_likelihoods", [event, "'raw'", r, f"'{i}'", f"'{x}'", s]) for i, r, x, s in ((0, f"'r' || {k}", "A*", f"'-' || {a} || '.0'"), (0, f"'r' || {k}", "C", "'-2.0'"), (1, f"'s' || {k}", "A*", "'-3.0'"), (1, f"'s' || {k}", "C", f"'-' || {b} || '.5'"))),
        *(("allele_likelihoods", [event, "'normalized'", f"'r' || {k}", "'0'", f"'{x}'", s]) for x, s in (("A*", "'0'"), ("C", f"'-' || {b}"))),
    ]
    return " UNION ALL ".join(f"SELECT '{name}' AS \"table\", concat_ws(chr(9), {region}, {', '.join(cells)}) AS value FROM supplier" for name, cells in rows)


@query("genotyper_debug_tables", _debug_sql())
def genotyper_debug_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six tables of a debug text that has one block of lines for each supplier, rows as tab-separated text."""
    texts = F.array(*(F.concat(*(F.expr(x.replace("VARCHAR", "STRING")) for x in _filled(line))) if line else F.lit("") for line in BLOCK))
    lines = read_table(spark, sf_dir, "supplier").select(F.lit("debug").alias("path"), "s_suppkey", F.posexplode(texts).alias("k", "value"))
    tables = debug_text.genotyper(lines.select("path", (F.col("s_suppkey") * 1000 + F.col("k") * 20).alias("offset"), "value"))
    as_text = lambda df: F.concat_ws("\t", *(F.col(c).cast("string") for c in df.columns))
    return functools.reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("table"), as_text(df).alias("value")) for name, df in tables.items()])

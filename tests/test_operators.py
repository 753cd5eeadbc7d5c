"""Operators on small tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lociframe.functions import cigar
from lociframe.operators import intervals, overhangs, overlap, reads, variants

IV = "contig long, start long, end long"


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_merge_rules(spark):
    df = spark.createDataFrame([(1, 1, 10), (2, 5, 8), (1, 11, 20)], IV)
    assert rows(intervals.merge(df, 1), "contig", "start", "end") == [(1, 1, 20), (2, 5, 8)]
    assert rows(intervals.merge(df, 0), "contig", "start", "end") == [(1, 1, 10), (1, 11, 20), (2, 5, 8)]
    assert intervals.merge(df.limit(0), 1).count() == 0


def test_scatter(spark):
    ten = spark.createDataFrame([(1, 10 * i + 1, 10 * i + 10) for i in range(10)], IV)
    assert [r[0] for r in intervals.scatter(ten, 3).groupBy("shard").agg(F.sum("len")).orderBy("shard").select("sum(len)").collect()] == [30, 40, 30]
    at, out = 0, []
    for n in (5, 100, 5, 5, 5, 60, 20):
        out.append((1, at + 1, at + n))
        at += n + 10
    assert [r[0] for r in intervals.scatter(spark.createDataFrame(out, IV), 3).groupBy("shard").agg(F.sum("len")).orderBy("shard").select("sum(len)").collect()] == [105, 15, 80]


def test_scatter_to_more_shards_than_intervals(spark):
    """With filled=False each cut is the nearest one alone, as the SQL of interval_scatter has it."""
    lengths = (200, 190, 210, 205, 3)
    df = spark.createDataFrame([(c, 1, n) for c, n in enumerate(lengths)], IV)
    prefix = [sum(lengths[: i + 1]) for i in range(5)]
    cuts = [min(range(5), key=lambda r: (abs(prefix[r] - (sum(lengths) * i + 3) // 7) * 2 + (prefix[r] >= (sum(lengths) * i + 3) // 7))) for i in range(1, 7)]
    assert rows(intervals.scatter(df, 7, filled=False), "contig", "shard") == [(r, sum(c < r for c in cuts)) for r in range(5)]
    assert rows(intervals.scatter(df, 7), "contig", "shard") == [(r, r) for r in range(5)]
    assert intervals.scatter(df.limit(0), 7, filled=False).count() == 0


def test_pad_and_intersect(spark):
    contigs = spark.createDataFrame([(1, 20)], "contig long, length long")
    df = spark.createDataFrame([(1, 3, 3), (1, 18, 18)], IV)
    assert rows(intervals.pad_clamp(df, contigs, 10), "start", "end") == [(1, 13), (8, 20)]
    a = spark.createDataFrame([(2, 1, 20), (1, 40, 100)], IV)
    b = spark.createDataFrame([(2, 5, 10), (1, 50, 60), (1, 80, 90)], IV)
    assert rows(intervals.intersect(a, b), "contig", "start", "end") == [(1, 50, 60), (1, 80, 90), (2, 5, 10)]


def test_overlap_join_gives_each_pair_once(spark):
    a = spark.createDataFrame([(1, 1, 5000), (1, 900, 2100)], IV)
    b = spark.createDataFrame([(1, 1000, 4000), (1, 5000, 5000), (2, 1, 9)], IV)
    assert rows(overlap.overlap_join(a, b, 1000), "start", "r_start") == [(1, 1000), (1, 5000), (900, 1000)]
    p = spark.createDataFrame([(1, 9), (1, 10), (1, 12), (1, 13), (1, 20)], "contig long, pos long")
    known = spark.createDataFrame([(1, 10, 12), (1, 20, 20)], IV)
    assert rows(overlap.positions_within(p, known), "pos") == [(10,), (12,), (20,)]
    assert rows(overlap.positions_within(p, known, anti=True), "pos") == [(9,), (13,)]


READ = "qname string, flag int, contig string, contig_idx int, pos long, mapq int, cigar string, seq string, qual array<int>, library string"


def test_duplicates(spark):
    def pair(name, q):
        return [(name, 0x1 | 0x40, "1", 0, 100, 60, "10M", "A" * 10, [q] * 10, "lib"), (name, 0x1 | 0x80 | 0x10, "1", 0, 300, 60, "10M", "A" * 10, [q] * 10, "lib")]

    df = spark.createDataFrame(pair("a", 20) + pair("b", 30) + [("c", 0x400, "1", 0, 100, 60, "10M", "A" * 10, [30] * 10, "lib")], READ)
    marked = reads.mark_duplicates(df)
    assert rows(marked.where(F.col("flag").bitwiseAND(0x400) != 0), "qname") == [("a",), ("a",)]
    m = reads.duplication_metrics(marked).first()
    assert (m["pairs_examined"], m["pair_duplicates"], m["unpaired_examined"], m["unpaired_duplicates"]) == (2, 1, 1, 0)


def test_duplicates_of_all_lines(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.01"
    got = {(r["library"], r["paired"]): (r["reads"], r["duplicates"]) for r in entry.queries()["mark_duplicates"](spark, sf).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{sf}/lineitem.parquet'")
    assert got == {(x[0], x[1]): (x[2], x[3]) for x in con.sql(entry.oracle_sql()["mark_duplicates"]).fetchall()}
    assert sum(n for n, _ in got.values()) == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert all(0 < sum(d for (_, p), (_, d) in got.items() if p == paired) for paired in (True, False))


def test_every_read_is_scored(spark):
    sf = "/root/testdata/sf0.001"
    out = entry.queries()["pair_hmm_scores"](spark, sf).cache()
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    assert out.count() == 2 * lines.count() and out.where("score is null or score = -1000").count() == 0
    want = lines.groupBy(F.col("l_orderkey").cast("string").alias("qname")).agg((2 * F.count("*")).alias("n"))
    assert out.groupBy("qname").agg(F.count("*").alias("n")).exceptAll(want).count() == 0


def test_split_reads(spark):
    df = spark.createDataFrame([("r", 0, 100, 255, "5M10N5M", {"NM": "1", "RG": "x"}), ("u", 4, 7, 255, "5M10N5M", {"NM": "1"})], "qname string, flag int, pos long, mapq int, cigar string, tags map<string,string>")
    got = rows(reads.split_reads(df), "qname", "flag", "pos", "mapq", "cigar")
    assert got == [("r", 0, 100, 60, "5M5S"), ("r", 0x800, 115, 60, "5S5M"), ("u", 4, 7, 60, "5M10N5M")]
    assert {tuple(r["tags"]) for r in reads.split_reads(df).where("qname = 'r'").collect()} == {("RG",)}


def test_pileup(spark):
    df = spark.createDataFrame([("1", 9, "3M1D2M", "ACGTA", [30] * 5)], "contig string, pos long, cigar string, seq string, qual array<int>")
    got = rows(reads.aligned(df, "contig").select("pos", "qpos", F.coalesce("base", F.lit("-")).alias("b"), "is_del", "indel"), "pos", "qpos", "b", "is_del", "indel")
    assert got == [(10, 0, "A", False, 0), (11, 1, "C", False, 0), (12, 2, "G", False, -1), (13, 3, "-", True, 0), (14, 3, "T", False, 0), (15, 4, "A", False, 0)]
    c = lambda *x: spark.range(1).select(reads.is_candidate(*[F.lit(v) for v in x])).first()[0]
    assert [c(10, 1, 0), c(10, 2, 0), c(10, 0, 1)] == [False, True, True]


def test_vcf_compare(spark):
    text = lambda *xs: spark.createDataFrame([(x,) for x in ("##h", "", *xs)], "value string")
    a = variants.parse_vcf(text("1\t10\t.\tA\tG,T\t50\tPASS\tDP=3\tGT\t0/1"))
    b = variants.parse_vcf(text("1\t10\trs1\tA\tG\t50\tPASS\t.\tGT\t1/1"))
    s = variants.comparison_summary(variants.compare(a, b)).first()
    assert (s["a_count"], s["b_count"], s["shared"], s["a_private_snp"], s["gt_diff"]) == (2, 1, 1, 1, 1)


def test_stage_diff_and_known_sites(spark):
    a = spark.createDataFrame([(1, "1.0", None), (2, "x", "y")], "id int, v string, w string")
    b = spark.createDataFrame([(1, "1.0004", ""), (3, "x", "y")], "id int, v string, w string")
    assert rows(variants.stage_diff(a, b, ["id"], 1e-3), "id", "status") == [("2", "a_only"), ("3", "b_only")]
    assert rows(variants.stage_diff(a, b, ["id"], 1e-6), "id", "field", "status") == [("1", "v", "diff"), ("2", "", "a_only"), ("3", "", "b_only")]
    calls = spark.createDataFrame([("1", 5, "A", "ATG")], "chrom string, pos long, ref string, alt string")
    known = lambda alt: spark.createDataFrame([("1", 5, "rs1", "A", alt, 0)], "chrom string, pos long, id string, ref string, alt string, ordinal long")
    assert variants.annotate_known(calls, known("C,ATG")).first()["id"] == "rs1"
    assert variants.annotate_known(calls, known("C,G")).first()["db"] is False


def test_split_regions_against_a_loop(spark):
    import random

    rng = random.Random(2)
    loci = {p: rng.randint(4, 9) for p in rng.sample(range(1, 4000), 900)}
    spans = [(1, 1, 4000), (1, 5000, 5100), (1, 6000, 6400)]
    want = []
    for c, start, end in spans:
        while end - start + 1 > 300:
            places = range(start + 50, min(start + 300, end - 50) + 1)
            middle = (places[0] + places[-1]) // 2
            cut = min(places, key=lambda p: (loci.get(p, 0), abs(p - middle)))
            want.append((c, start, cut - 1))
            start = cut
        want.append((c, start, end))
    table = spark.createDataFrame([(1, p, q) for p, q in loci.items()] + [(1, 6000, 5), (1, 6399, 5)], "contig long, pos long, qual int")
    assert rows(reads.split_regions(spark.createDataFrame(spans, IV), table), "contig", "start", "end") == sorted(want)


def test_running_windows_over_bins(spark, monkeypatch):
    import random

    monkeypatch.setattr(intervals, "BIN", 16)
    rng = random.Random(1)
    iv = [(rng.randint(1, 2), s, s + rng.randint(0, 40)) for s in (rng.randint(1, 900) for _ in range(120))]
    want = []
    for c, s, e in sorted(iv):
        if want and want[-1][0] == c and s <= want[-1][2] + 1:
            want[-1] = (c, want[-1][1], max(e, want[-1][2]))
        else:
            want.append((c, s, e))
    assert rows(intervals.merge(spark.createDataFrame(iv, IV), 1), "contig", "start", "end") == want
    regions = []
    for c, p in sorted({(c, s) for c, s, _ in iv}):
        if regions and regions[-1][0] == c and p <= regions[-1][2] + 10:
            regions[-1] = (c, regions[-1][1], p, regions[-1][3] + 1)
        else:
            regions.append((c, p, p, 1))
    points = spark.createDataFrame([(c, s) for c, s, _ in iv], "contig long, pos long")
    assert rows(intervals.chain(points, 10), "contig", "start", "end", "n_loci") == regions


def test_indels_of_all_operations(spark):
    df = spark.createDataFrame([("1", 9, "2H1S3M2I2M4N3M1D2M1S", "TACGGGTTAAACCG", [30] * 14)], "contig string, pos long, cigar string, seq string, qual array<int>")
    bases = reads.aligned(df, "contig")
    assert rows(bases.where("not is_del"), "pos", "qpos", "base", "indel") == [(10, 1, "A", 0), (11, 2, "C", 0), (12, 3, "G", 2), (13, 6, "T", 0), (14, 7, "T", 0), (19, 8, "A", 0), (20, 9, "A", 0), (21, 10, "A", -1), (23, 11, "C", 0), (24, 12, "C", 0)]
    found = reads.indel_evidence(reads.indel_observations(bases)).where("alt_count > 0")
    assert rows(found, "pos", "best_indel", "alt_count") == [(12, "INS:GG", 1), (21, "DEL:1", 1)]


def test_candidate_intervals_when_empty(spark):
    wanted, contigs = spark.createDataFrame([(1, 5, 30)], IV), spark.createDataFrame([(1, 100)], "contig long, length long")
    sites = spark.createDataFrame([(1, 8), (1, 60)], "contig long, pos long")
    assert rows(intervals.candidate_intervals(sites, wanted, contigs, 4), "contig", "start", "end") == [(1, 5, 12)]
    assert rows(intervals.candidate_intervals(sites.limit(0), wanted, contigs, 4, "input"), "contig", "start", "end") == [(1, 5, 30)]
    with pytest.raises(Exception, match="no candidate interval"):
        intervals.candidate_intervals(sites.where("pos = 60"), wanted, contigs, 4).collect()


def test_clipped_left(spark):
    df = spark.createDataFrame([("2H3S10M", 5), ("4M2D6M", 4), ("4M1I6M", 5), ("10M2H", 3), ("3M5N7M", 2)], "cigar string, n int")
    out = df.withColumn("c", cigar.clipped_left(cigar.ops(F.col("cigar")), F.col("n"))).select("cigar", cigar.text(F.col("c.ops")), "c.moved")
    assert sorted(map(tuple, out.collect())) == [("10M2H", "3S7M2H", 3), ("2H3S10M", "2H5S8M", 2), ("3M5N7M", "2S1M5N7M", 2), ("4M1I6M", "5S6M", 4), ("4M2D6M", "4S6M", 6)]


def test_overhangs(spark):
    spliced = spark.createDataFrame([(0, "c", 10, "5M20N2D4M3N6M"), (0, "c", 10, "5M20N2D4M3N6M"), (4, "c", 1, "3M4N3M"), (256, "c", 1, "3M4N3M"), (0, "c", 1, "9M"), (0, "c", 1, "*"), (0, "c", 1, None)], "flag int, contig string, pos long, cigar string")
    found = overhangs.splices(spliced)
    assert rows(found, "contig", "start", "end", "reads") == [("c", 15, 36, 2), ("c", 41, 43, 2)]
    spl = spark.createDataFrame([("c", 100, 199, "A" * 40, "G" * 40)], "contig string, start long, end long, head string, tail string")
    reads_ = [
        ("left", 0, "c", 195, "20M", "TTTTT" + "C" * 15), ("fits", 0, "c", 195, "20M", "GGGGG" + "C" * 15), ("one off", 0, "c", 195, "20M", "GGGGT" + "C" * 15),
        ("right", 0, "c", 88, "15M1S", "C" * 12 + "TTT" + "C"), ("half", 0, "c", 99, "4M", "CTTT"), ("far", 0, "c", 500, "4M", "CTTT"), ("unmapped", 4, "c", 195, "20M", "T" * 20), ("none", 0, None, None, None, None), ("short seq", 0, "c", 195, "20M", "*"),
    ]
    df = spark.createDataFrame(reads_, "id string, flag int, contig string, pos long, cigar string, seq string")
    got = {r["id"]: (r["pos"], r["cigar"], r["clipped"]) for r in overhangs.clip_overhangs(df, spl).collect()}
    assert got.pop("left") == (200, "5S15M", True) and got.pop("right") == (88, "12M4S", True)
    assert got == {r[0]: (r[3], r[4], False) for r in reads_ if r[0] in got}
    assert overhangs.clip_overhangs(df, spl.limit(0)).where("clipped").count() == 0 and overhangs.clip_overhangs(df.limit(0), spl).count() == 0


def test_fallback_and_clusters(spark):
    loci = spark.createDataFrame(
        [("c", 1, "A", 20, 10, "G", 0, None), ("c", 2, "A", 9, 9, "G", 0, None), ("c", 3, "A", 12, 0, "", 6, "INS:TT"), ("c", 4, "A", 12, 0, "", 12, "DEL:2"), ("c", 5, "A", 90, 3, "G", 0, None), ("c", 6, "N", 20, 10, "G", None, None)],
        "contig string, pos long, ref_base string, depth long, snp_alt_count long, snp_best_alt string, indel_alt_count long, indel_best_alt string",
    )
    assert rows(variants.pileup_fallback(loci), "pos", "ref", "alt", "ref_count", "alt_count", "genotype") == [(1, "A", "G", 10, 10, 1), (3, "A", "ATT", 6, 6, 1), (5, "A", "G", 87, 3, 0)]
    assert rows(variants.zero_candidate_seeds(loci), "pos") == [(5,)]
    calls = spark.createDataFrame([("c", 10, "A", "G", 3), ("c", 10, "A", "C", 9), ("c", 20, "A", "AT", 1), ("c", 40, "A", "G", 9), ("c", 99, "A", "G", 1)], "contig string, pos long, ref string, alt string, alt_count long")
    assert rows(variants.without_weak_snps(calls, calls.where("pos in (10, 40)")), "pos", "alt") == [(10, "C"), (20, "AT"), (40, "G"), (99, "G")]
    held = calls.where("pos = 40")
    # two SNPs at one position and one near it crowd each other
    assert rows(variants.without_unsupported_snps(calls, held), "pos", "alt") == [(20, "AT"), (40, "G"), (99, "G")]
    assert rows(variants.without_unsupported_snps(calls, held.limit(0)), "pos", "alt") == [(20, "AT"), (40, "G"), (99, "G")]


def test_genotype_table(spark):
    lines = ["#h", "", "c\t5\t.\tA\tC,G\t9\tPASS\tDP=4;DB\tGT:AD:DP\t0/1:1,2,3:7", "c\t6\t.\tA\tC\t9\tPASS\tDP=4;FS=1\tGT\t0/1", "c\t7\t.\tA\tC\t9\tq\t."]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = rows(variants.genotype_table(df), "pos", "alt", "gt", "dp", "ad_ref", "ad_alt", "fs", "db")
    assert got == [(5, "C,G", "0/1", "7", "1", "2,3", "", True), (6, "C", "0/1", "4", "", "", "1", False), (7, "C", "", "", "", "", "", False)]


def test_candidate_intervals_without_any_may_be_none(spark):
    """The query's SQL has no rows then."""
    sites, wanted = spark.createDataFrame([(1, 8), (1, 60)], "contig long, pos long"), spark.createDataFrame([(1, 5, 30)], IV)
    contigs = spark.createDataFrame([(1, 100)], "contig long, length long")
    assert rows(intervals.candidate_intervals(sites.where("pos = 60"), wanted, contigs, 4, "none"), "contig", "start", "end") == []
    assert rows(intervals.candidate_intervals(sites, wanted, contigs, 4, "none"), "contig", "start", "end") == [(1, 5, 12)]

"""Text sources and the pair model."""

import numpy as np
import pytest

from lociframe.operators import pair_hmm
from lociframe.sources import text


@pytest.mark.parametrize(
    ("read", "hap", "want"),
    [("ACGTACGTAC", "ACGTACGTAC", -1.050334), ("ACGTTCGTAC", "ACGTACGTAC", -4.526722), ("GTAC", "ACGTACGTAC", -0.746533), ("ACGTACCGTAC", "ACGTACGTAC", -5.294618), ("ACGTCGTAC", "ACGTACGTAC", -5.561703), ("NNNN", "ACGT", -0.649553)],
)
def test_pair_model(read, hap, want):
    q = np.full((1, len(read)), 30.0)
    got = pair_hmm.forward(np.array([list(read.encode())]), np.array([list(hap.encode())]), q, np.full_like(q, 45.0))
    assert got[0] == pytest.approx(want, abs=1e-5)


def test_scores_by_row(spark):
    df = spark.createDataFrame([(1, 0, "ACGTACGTAC", [30] * 10, "ACGTACGTAC"), (2, 0, "", [], "ACGT"), (3, 1, "GTAC", [30] * 4, "ACGTACGTAC")], "read_id int, hap_id int, seq string, qual array<int>, hap string")
    got = {r["read_id"]: r["score"] for r in pair_hmm.score(df).collect()}
    assert got[1] == pytest.approx(-1.050334, abs=1e-5) and got[2] == -1000 and got[3] == pytest.approx(-0.746533, abs=1e-5)


def write(tmp_path, name, *lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_intervals_and_dictionary(spark, tmp_path):
    d = text.contigs(spark, write(tmp_path, "d.dict", "@HD\tVN:1", "@SQ\tSN:chr2\tLN:50", "@SQ\tSN:chr1\tLN:100"))
    assert [tuple(r) for r in d.orderBy("contig_idx").collect()] == [("chr2", 0, 50), ("chr1", 1, 100)]
    b = text.bed(spark, write(tmp_path, "a.bed", "# c", "track x", "chr1\t0\t10", "", "chr2 5 8"))
    assert sorted(map(tuple, text.within_dictionary(b, d).select("contig", "start", "end", "contig_idx").collect())) == [("chr1", 1, 10, 1), ("chr2", 6, 8, 0)]
    bad = write(tmp_path, "b.bed", "chr1\t9\t9")
    with pytest.raises(Exception, match="bad BED line"):
        text.bed(spark, bad).collect()
    assert text.bed(spark, bad, strict=False).count() == 0
    i = text.interval_list(spark, write(tmp_path, "i.interval_list", "@SQ\tSN:chr1\tLN:9", "chr1\t2\t4\t+\t."))
    assert i.first()[:] == ("chr1", 2, 4)
    with pytest.raises(Exception, match="not in the dictionary"):
        text.within_dictionary(text.bed(spark, write(tmp_path, "c.bed", "chr2\t0\t51")), d).collect()


def test_gtf_sam_and_vcf(spark, tmp_path):
    g = text.gtf_exons(spark, write(tmp_path, "g.gtf", "#x", "chr1\ta\texon\t5\t9\t.", "chr1\ta\tgene\t1\t9\t.", "chrZ\ta\texon\t5\t9\t."), spark.createDataFrame([("chr1",)], "contig string"))
    assert [tuple(r) for r in g.collect()] == [("chr1", 4, 9)]
    s = text.sam(spark, write(tmp_path, "r.sam", "@HD\tVN:1", "r1\t99\tchr1\t101\t60\t4M\t=\t201\t100\tACGT\tIIII\tRG:Z:a:b\tNM:i:1")).first()
    assert (s["pos"], s["mate_contig"], s["mate_pos"], s["qual"], s["tags"]) == (100, "chr1", 200, [40] * 4, {"RG": "a:b", "NM": "1"})
    c = spark.createDataFrame([("1", 10, None, False, "A", "G", 109, 1, 10, 5, 5, 0.0, [109, 0, 179])], "chrom string, pos long, id string, db boolean, ref string, alt string, qual int, genotype int, depth int, ref_count int, alt_count int, fs double, pl array<int>")
    assert text.vcf_lines(c).first()[0] == "1\t10\t.\tA\tG\t109\tPASS\tAC=1;AF=0.500;AN=2;DP=10;FS=0.000;QD=10.90\tGT:AD:DP:GQ:PL\t0/1:5,5:10:99:109,0,179"


def test_read_groups(spark, tmp_path):
    g = text.read_groups(spark, write(tmp_path, "h.sam", "@HD\tVN:1", "@RG\tID:a\tPU:u\tLB:one\tSM:", "@RG\tID:b\tSM:who", "@RG\tID:c\tPU:u", "@RG\tID:b\tLB:two"))
    assert sorted(map(tuple, g.select("rg", "unit", "unit_idx", "library").collect())) == [("a", "u", 0, "one"), ("b", "b", 1, "two"), ("c", "u", 0, "Unknown Library")]
    assert text.sample_name(g) == "SAMPLE" and text.sample_name(text.read_groups(spark, write(tmp_path, "s.sam", "@RG\tID:x\tSM:me"))) == "me"
    reads = spark.createDataFrame([(1, {"RG": "a"}), (2, {"RG": "z"}), (3, {}), (4, None)], "id int, tags map<string,string>")
    assert sorted(map(tuple, text.with_read_group(reads, g, strict=False).select("id", "unit", "library").collect())) == [(1, "u", "one"), (2, None, "Unknown Library"), (3, None, "Unknown Library"), (4, None, "Unknown Library")]
    with pytest.raises(Exception, match="unknown read group: z"):
        text.with_read_group(reads.where("id < 3"), g).collect()
    with pytest.raises(Exception, match="without ID"):
        text.read_groups(spark, write(tmp_path, "bad.sam", "@RG\tSM:x")).collect()


def test_interval_sinks(spark, tmp_path):
    d = text.contigs(spark, write(tmp_path, "d.dict", "@SQ\tSN:chr2\tLN:50", "@SQ\tSN:chr1\tLN:100"))
    iv = spark.createDataFrame([(1, "chr1", 5, 9), (0, "chr2", 7, 8), (0, "chr2", 1, 3)], "shard int, contig string, start long, end long")
    head = ["@SQ\tSN:chr2\tLN:50", "@SQ\tSN:chr1\tLN:100"]
    assert [r[0] for r in text.interval_list_lines(iv, d).collect()] == ["@HD\tVN:1.6", *head, "chr2\t1\t3\t+\t.", "chr2\t7\t8\t+\t.", "chr1\t5\t9\t+\t."]
    assert text.interval_list_lines(iv.limit(0), d).count() == 3
    for _ in range(2):
        text.write_scattered(iv, d, str(tmp_path / "shards"))
    files = {p.parent.name: p.read_text().split("\n")[:-1] for p in (tmp_path / "shards").glob("*/part-*.txt")}
    assert files == {"scatter=0000": [*head, "chr2\t1\t3\t+\t.", "chr2\t7\t8\t+\t."], "scatter=0001": [*head, "chr1\t5\t9\t+\t."]}
    with pytest.raises(Exception, match="not in the dictionary"):
        text.interval_list_lines(spark.createDataFrame([("chrX", 1, 2)], "contig string, start long, end long"), d).collect()


def test_metrics_lines(spark):
    cols = "library string, unpaired_examined long, pairs_examined long, secondary_or_supplementary long, unmapped long, unpaired_duplicates long, pair_duplicates long, percent_duplication double, library_size long"
    lines = [r[0] for r in text.metrics_lines(spark.createDataFrame([("b", 1, 2, 0, 0, 0, 1, 0.4, 7), ("a", 1, 0, 0, 3, 0, 0, 0.0, None)], cols)).collect()]
    assert lines[0].startswith("## METRICS CLASS") and lines[1].startswith("LIBRARY\t")
    assert lines[2:] == ["a\t1\t0\t0\t3\t0\t0\t0\t0.000000\t", "b\t1\t2\t0\t0\t0\t1\t0\t0.400000\t7"]


def test_region_lines(spark):
    rows = [("b_private_snp", "2", 1, 110, 10, "A", "T", "SNP", None, "0/1"), ("a_private_indel", "1", 50, 260, 150, "AC", "A", "INDEL_OR_COMPLEX", "1/1", None)]
    df = spark.createDataFrame(rows, "category string, chrom string, start long, end long, pos long, ref string, alt string, type string, a_gt string, b_gt string")
    lines = lambda f: [r["value"] for r in f(df).collect()]
    assert lines(text.region_manifest_lines)[0].split("\t") == ["category", "chrom", "start", "end", "pos", "ref", "alt", "type", "a_gt", "b_gt"]
    assert lines(text.region_manifest_lines)[2] == "b_private_snp\t2\t1\t110\t10\tA\tT\tSNP\t\t0/1"
    assert lines(text.region_bed_lines) == ["1\t49\t260\ta_private_indel_1:150:AC>A", "2\t0\t110\tb_private_snp_2:10:A>T"]
    assert lines(text.region_interval_lines) == ["1\t50\t260\t+\ta_private_indel", "2\t1\t110\t+\tb_private_snp"]
    assert lines(lambda _: text.region_manifest_lines(df.limit(0))) == ["category\tchrom\tstart\tend\tpos\tref\talt\ttype\ta_gt\tb_gt"]

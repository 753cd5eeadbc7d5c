"""Stage tables in both formats, summary files, counters and mate repair on small cases."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lociframe.functions import cigar as C
from lociframe.operators import mates, reads, variants
from lociframe.sources import blocks, comparison, debug_text, text


def test_stage_tables_in_both_formats(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tn\tx\n1\t2.50\ta \\ b\n2\t\n")
    (tmp_path / "a.jsonl").write_text('\n  {"id": 1, "n": 2.50, "x": "a \\\\ b"}\n{"x": null, "id": "2"}\n')
    rows = lambda p: sorted(tuple(r[c] for c in ("id", "n", "x")) for r in text.stage_table(spark, str(tmp_path / p)).collect())
    assert rows("a.tsv") == [("1", "2.50", "a \\ b"), ("2", "", "")]
    assert [(i, float(n) if n else n, x) for i, n, x in rows("a.jsonl")] == [("1", 2.5, "a \\ b"), ("2", "", "")]
    (tmp_path / "b.jsonl").write_text('{"k": {"b": [1, {"c": "d"}], "a": true}, "m": [1,2]}\n')
    r = text.stage_table(spark, str(tmp_path / "b.jsonl")).first()
    assert (r["k"], r["m"]) == ('{"b":[1,{"c":"d"}],"a":true}', "[1,2]")
    (tmp_path / "bad.jsonl").write_text('{"k": 1}\n{"k": \n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        text.stage_table(spark, str(tmp_path / "bad.jsonl")).collect()


def test_json_escape(spark):
    values = ['a"b', "back\\slash", "l1\nl2\rl3\tt", "", "é / '"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(comparison.json_escape(F.col("v"))).collect()]
    assert [json.loads(f'"{g}"') for g in got] == values


def test_comparison_files(spark):
    kind = "chrom string, pos long, ref string, alt string, gt string, filter string"
    a = spark.createDataFrame([("c", 1, "A", "C", "0/1", "PASS"), ("c", 2, "A", "AC", "0/1", "PASS"), ("c", 3, "A", "T", "0/1", "QD")], kind)
    b = spark.createDataFrame([("c", 1, "A", "C", "1/1", "PASS"), ("c", 2, "A", "AC", "0/1", "FS"), ("c", 9, "G", "T", "0/1", "PASS")], kind)
    files = {}
    for r in comparison.comparison_files(variants.compare(a, b), 'say "a"', "b").collect():
        files.setdefault(r["file"], []).append(r["value"])
    told = json.loads("\n".join(files["summary.json"]))
    assert told["a_label"] == 'say "a"' and told["all_records"] == {"a_count": 3, "b_count": 3, "shared": 2, "a_private": 1, "b_private": 1, "a_sensitivity": 66.666667, "b_precision_vs_a": 66.666667, "gt_same": 1, "gt_diff": 1}
    assert told["pass_records"]["shared"] == 1 and told["pass_records"]["a_private"] == 1 and told["pass_records"]["b_private"] == 1
    assert files["details.tsv"][0].startswith("category\tchrom") and len(files["details.tsv"]) == 5
    assert files["summary.tsv"][0].split("\t")[:3] == ["set", "a_count", "b_count"] and "QD:1" in files["summary.md"][6] and len(files["summary.md"]) == 15
    empty = comparison.comparison_files(variants.compare(a.limit(0), b.limit(0)), "a", "b").collect()
    assert sum(r["file"] == "details.tsv" for r in empty) == 1 and "| a | 0 | 0 | 0 | 0 | 0 | 0 | 0 |  |" in [r["value"] for r in empty]


def test_stage_files_and_candidate_summary(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    b = spark.createDataFrame([(1, "z"), (3, "y")], "id long, v string")
    rows = [r["value"] for r in comparison.stage_files(variants.stage_diff(a, b, ["id"]), variants.stage_summary(a, b, ["id"]), ["id"], "s", 0.0).collect()]
    assert "field_diff\t1\tv\tx\tz" in rows and "a_private\t2\t\t\t" in rows and "s\t2\t2\t1\t1\t1\t1\t1" in rows
    sites = spark.createDataFrame([(10, 4), (11, 0)], "pos long, depth long")
    spans = spark.createDataFrame([(1, 100)], "start long, end long")
    out = {r["metric"]: r["value"] for r in comparison.candidate_summary(sites, spans, spans.limit(0), F.col("depth") > 100, {"padding": 7}).collect()}
    assert out["used_input_fallback"] == "true" and out["output_bases"] == "100" and out["mean_filtered_depth"] == "4.000" and out["padding"] == "7" and out["reduction_fraction"] == "0.000000"


def test_mates_of_repeated_names_stay_apart(spark):
    kind = "qname string, flag int, contig string, pos long, cigar string, mapq int, mate_pos long, tags map<string,string>, ordinal long"
    rows = [
        ("r", 0x1 | 0x40, "c", 100, "5M", 60, 500, {"MC": "9M"}, 0), ("r", 0x1 | 0x80, "c", 500, "9M", 60, 100, {}, 1),
        ("r", 0x1 | 0x40, "c", 100, "5M", 60, 700, {"MC": "8M"}, 2), ("r", 0x1 | 0x40 | 0x4, "c", 100, "*", 0, 500, {"MC": "9M"}, 3), ("r", 0x40, "c", 1, "5M", 60, 500, {}, 4),
    ]
    df = spark.createDataFrame(rows, kind)
    clipped = spark.createDataFrame([("r", 0x1 | 0x80, 503, 500, "3S6M", 1), ("r", 0x1 | 0x80 | 0x100, 600, 700, "x", 5), ("r", 0x1 | 0x80, 502, 500, "2S7M", 0)], "qname string, flag int, pos long, old_pos long, cigar string, ordinal long")
    got = {r["ordinal"]: (r["mate_pos"], dict(r["tags"])) for r in mates.repair_mates(df, mates.changed_mates(clipped)).collect()}
    assert got == {0: (503, {"MC": "3S6M"}), 1: (100, {}), 2: (700, {"MC": "8M"}), 3: (500, {"MC": "9M"}), 4: (500, {})}


def test_supplementary_tags(spark):
    kind = "flag int, contig string, pos long, cigar string, mapq int, tags map<string,string>"
    df = spark.createDataFrame([(16, "c", 9, "5M10N6M7N4M", 255, {"SA": "x,1,+,3M,0,0;", "NM": "1", "MC": "4M9N5M"}), (0, "c", 0, "5M", 9, {"NM": "2", "MC": "4M9N5M"})], kind)
    out = [(r["pos"], r["cigar"], r["flag"], r["mapq"], dict(r["tags"])) for r in mates.split_with_tags(df).collect()]
    e = ["c,10,-,5M10S,60,*;", "c,25,-,5S6M4S,60,*;", "c,38,-,11S4M,60,*;"]
    own = "x,1,+,3M,0,0;"
    assert out == [(9, "5M10S", 16, 60, {"MC": "4M5S", "SA": own + e[1] + e[2]}), (24, "5S6M4S", 16 | 2048, 60, {"MC": "4M5S", "SA": e[0] + own + e[2]}), (37, "11S4M", 16 | 2048, 60, {"MC": "4M5S", "SA": e[0] + own + e[1]}), (0, "5M", 0, 9, {"NM": "2", "MC": "4M9N5M"})]
    seen = Observation("s")
    assert reads.split_reads(df, seen).count() == 4 and seen.get == {"input": 2, "output": 4, "split": 1, "mapq_changed": 1}
    assert [r[0] for r in df.select(C.sections(F.col("cigar"))[0]["cigar"]).collect()] == ["5M10S", "5M"]


def test_region_stats(spark):
    loci = spark.createDataFrame([("c", 5, 10, 5, True), ("c", 6, 0, 0, False), ("c", 50, 4, 1, True)], "contig string, pos long, depth long, alt_count long, active boolean")
    areas = spark.createDataFrame([(1, "c", 1, 10), (2, "c", 20, 30), (3, "c", 6, 60)], "region int, contig string, start long, end long")
    got = {r["region"]: tuple(r)[4:] for r in reads.region_stats(loci, areas).collect()}
    assert got == {1: (2, 1, 0.5, 0.25), 2: (0, 0, 0.0, 0.0), 3: (2, 1, 0.25, 0.125)}


DEBUG = """calling for region: c:1-50
Unclipped Haplotypes(2):
[1-50] k=10 len 50 50Mref
ACGT
[2-49] k=25 len 48 20M2D28M
calling for region: c:1-60
TTTT
[broken k=
not bases
Clipped Haplotypes(1):
[3-9] k=5 len 7 7M
GG

read 3: r a cigar: 10M mapQ: 60 loc: c:5-14 unclippedloc: c:4-14 length:11
[30, 2]
read 4: b cigar: 5M mapQ: 7 loc: x unclippedloc: y
,-1.5,,-2.5
read 5: lost cigar: 5M mapQ: 7 loc: x unclippedloc: y

,-9
Allele: early Haps: none
Event at: [VC z @ c:100 Q. type=SNP alleles=[A*, C] more
Allele: A* Haps: [0, 1]
Allele: C
Read-allele matrix:
A* C
read: 0 b -1.0 -2.0 -9
read: x b -1.0
read: 1 b -1.0 -2.0
Normalized Read-Allele matrix:

read: 2 b 0
Normalized Read-Allele matrix:
G
read: 3 d -4
Event at: nothing
"""


def test_genotyper_debug_text(spark, tmp_path):
    path = tmp_path / "debug.txt"
    path.write_text(DEBUG + "\n" * 70_000 + DEBUG)
    rows = {}
    for split in (1 << 20, 30_000):
        tables = debug_text.genotyper(blocks.read_lines(spark, str(path), split))
        rows[split] = {n: sorted(map(tuple, df.collect()), key=str) for n, df in tables.items()}
    assert rows[30_000] == rows[1 << 20]
    got = {n: sorted(set(x), key=str) for n, x in rows[30_000].items()}
    twice = lambda n, *want: (got[n] == sorted(want, key=str)) and len(rows[30_000][n]) == 2 * len(want)
    assert twice("haplotypes", ("c:1-50", "unclipped", 0, "1", "50", "10", "50", "50M", True, "ACGT"), ("c:1-60", "unclipped", 1, "2", "49", "25", "48", "20M2D28M", False, "TTTT"), ("c:1-60", "clipped", 0, "3", "9", "5", "7", "7M", False, "GG")), got["haplotypes"]
    assert twice("read_qualities", ("c:1-60", "r a", 3, "10M", "60", "c:5-14", "c:4-14", "11", "[30, 2]"))
    assert twice("pairhmm", *(("c:1-60", "b", 4, "5M", "7", "x", "y", "", k, s) for k, s in enumerate(("-1.5", "-2.5"))))
    event = "c:100:SNP:A*,C"
    assert twice("events", ("c:1-60", event, "c", "100", "SNP", "A*, C", "[VC z @ c:100 Q. type=SNP alleles=[A*, C] more"), ("c:1-60", ":::", "", "", "", "", "nothing"))
    assert set(got["event_alleles"]) == {("c:1-60", event, "A*", "[0, 1]"), ("c:1-60", event, "C", ""), ("c:1-60", ":::", "early", "none")}
    assert set(got["allele_likelihoods"]) == {("c:1-60", event, "raw", "b", 0, a, s) for a, s in (("A*", "-1.0"), ("C", "-2.0"), ("2", "-9"))} | {("c:1-60", event, "normalized", "d", 3, "G", "-4")}


def test_assembly_state(spark, tmp_path):
    path = tmp_path / "state.txt"
    path.write_text("c:1-9\nNumber of reads in region: 2\nr1 flags more\nr2\nr3 f\n\nskipped a\nThere were 2 haplotypes\nAC\n GT \nc:20-30\nThere were 1 x\nTT\nNumber of reads in region:\n\n")
    got = {n: sorted(map(tuple, df.collect()), key=str) for n, df in debug_text.assembly_state(blocks.read_lines(spark, str(path), 20)).items()}
    assert got == {"regions": [("c:1-9", "haplotypes", "2"), ("c:1-9", "reads", "2"), ("c:20-30", "haplotypes", "1")], "reads": [("c:1-9", "r1", "flags"), ("c:1-9", "r3", "f")], "haplotypes": [("c:1-9", 0, "AC"), ("c:1-9", 1, "GT"), ("c:20-30", 0, "TT"), ("c:20-30", 1, "Number of reads in region:")]}

"""Golden values of column functions and kernels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lociframe.functions import cigar as C
from lociframe.functions import likelihood as L
from lociframe.functions import sequence as Q
from lociframe.functions import vcf as V
from lociframe.operators import bqsr, intervals, reads
from split_reference import split_at_skips


@pytest.mark.parametrize(
    ("cigar", "parts"),
    [
        ("5M10N5M", [("5M5S", 0), ("5S5M", 15)]),
        ("1H2S3M8N4M5S6H", [("1H2S3M9S6H", 0), ("1H5S4M5S6H", 11)]),
        ("1H2M2D1M2N1M2I1N1M2S", [("1H2M2D1M6S", 0), ("1H3S1M2I3S", 7), ("1H6S1M2S", 9)]),
        ("4M3D5N2D4M", [("4M4S", 0), ("4S4M", 14)]),
        ("1S3N2M4H", [("1S3N2M4H", 0)]),
    ],
)
def test_split_at_skips(spark, cigar, parts):
    assert split_at_skips(cigar) == parts
    got = spark.createDataFrame([(cigar,)], "c string").select(C.sections(F.col("c"))).first()[0]
    assert [tuple(x) for x in got] == parts


def test_sections_against_reference(spark):
    rng, cigars, bad = random.Random(5), [], []
    for _ in range(1500):
        body = [(rng.choice([0, 1, 2, 7]), rng.choice("MMMIDDNNP=X")) for _ in range(rng.randint(1, 9))]
        ends = [[(3, "H")] * rng.randint(0, 1) + [(2, "S")] * rng.randint(0, 1), [(4, "S")] * rng.randint(0, 1) + [(1, "H")] * rng.randint(0, 1)]
        cigar = "".join(f"{n}{op}" for n, op in [*ends[0], *body, *ends[1]])
        try:
            cigars.append((cigar, split_at_skips(cigar)))
        except ValueError:
            bad.append(cigar)
    rows = spark.createDataFrame([(c,) for c, _ in cigars], "c string").select("c", C.sections(F.col("c")).alias("s")).collect()
    got = {r["c"]: [tuple(x) for x in r["s"]] for r in rows}
    assert len(bad) > 10 and sum(len(p) > 1 for _, p in cigars) > 300
    assert [(c, p, got[c]) for c, p in cigars if got[c] != p] == []
    for c in bad[:3]:
        with pytest.raises(Exception, match="deletions only"):
            spark.createDataFrame([(c,)], "c string").select(C.sections(F.col("c"))).collect()


def test_cigar_lengths_and_ends(spark):
    row = spark.createDataFrame([("2H3S40M10N5D2I7M7S", 99)], "c string, p int")
    ops = C.ops(F.col("c"))
    got = row.select(C.read_length(ops), C.reference_length(ops), C.leading_clips(ops), C.trailing_clips(ops), C.text(ops)).first()
    assert tuple(got) == (59, 62, 5, 7, "2H3S40M10N5D2I7M7S")
    r = spark.createDataFrame([("5S50M7S", 99)], "c string, p int").select(C.unclipped_five_prime(F.col("p"), C.ops(F.col("c")), F.lit(True)), C.unclipped_five_prime(F.col("p"), C.ops(F.col("c")), F.lit(False))).first()
    assert tuple(r) == (156, 95)
    assert spark.range(1).select(F.size(C.ops(F.lit("*"))), F.size(C.ops(F.lit(None).cast("string")))).first()[:] == (0, 0)


@pytest.mark.parametrize(("offset", "n", "rev", "second", "want"), [(0, 5, False, False, 1), (4, 5, False, False, 5), (0, 5, True, False, 5), (4, 5, True, False, 1), (0, 5, False, True, -1), (4, 5, True, True, -1)])
def test_cycle(spark, offset, n, rev, second, want):
    assert spark.range(1).select(Q.cycle(F.lit(offset), F.lit(n), F.lit(rev), F.lit(second))).first()[0] == want


def test_contexts(spark):
    row = spark.createDataFrame([("ACGT", [30, 30, 30, 30])], "s string, q array<int>")
    got = row.select(Q.contexts(F.col("s"), F.col("q"), F.lit(False)), Q.contexts(F.col("s"), F.col("q"), F.lit(True))).first()
    assert got[0] == [None, "AC", "CG", "GT"]
    assert got[1] == ["GT", "CG", "AC", None]
    low = spark.createDataFrame([("ACGT", [2, 2, 2, 2])], "s string, q array<int>").select(Q.contexts(F.col("s"), F.col("q"), F.lit(False))).first()[0]
    assert low == [None] * 4


@pytest.mark.parametrize(("ref", "alt", "qual", "pl", "gt"), [(5, 5, 109, [109, 0, 179], 1), (0, 20, 626, [626, 25, 0], 2), (29, 2, 0, [0, 59, 999], 0), (7, 3, 39, [39, 0, 248], 1), (20, 3, 3, [0, 0, 661], 1)])
def test_snp_model(spark, ref, alt, qual, pl, gt):
    g = L.genotype(L.diploid(F.lit(ref), F.lit(alt), F.lit(0.001)), L.SNP_PRIOR)
    got = spark.range(1).select(g.alias("g")).first()["g"]
    assert got["qual"] == qual and list(got["pl"]) == pl
    assert got["genotype"] == gt or got["pl"][got["genotype"]] == 0


@pytest.mark.parametrize(("table", "want"), [((10, 0, 0, 10), 49.6557), ((5, 5, 5, 5), 0.0), ((6, 4, 1, 3), 2.5225), ((300, 100, 20, 80), 96.6565)])
def test_fisher(spark, table, want):
    got = spark.range(1).select(L.fisher_strand(*[F.lit(x) for x in table])).first()[0]
    assert got == pytest.approx(want, abs=1e-3)


def test_library_size(spark):
    got = spark.range(1).select(reads.library_size(F.lit(7360339), F.lit(6758116)), reads.library_size(F.lit(10), F.lit(10))).first()
    assert got[0] == pytest.approx(42490397, abs=2) and got[1] is None


def test_log10_sum_exp(spark):
    v = F.array(F.lit(-1.0), F.lit(-2.0))
    assert spark.range(1).select(L.log10_sum_exp(v)).first()[0] == pytest.approx(math.log10(0.11))


def test_info_and_format(spark):
    row = spark.createDataFrame([("DP=3;DB;AF=0.5=x",), (".",), (None,)], "i string")
    got = [r[0] for r in row.select(V.info(F.col("i"))).collect()]
    assert got[0] == {"DP": "3", "DB": "true", "AF": "0.5=x"} and got[1] == {} and not got[2]
    assert spark.range(1).select(V.sample_value(F.lit("GT:AD"), F.lit("0/1"), "AD"), V.sample_value(F.lit("GT:AD"), F.lit("0/1:2,3"), "AD")).first()[:] == ("", "2,3")


def test_empirical_and_quantizer(spark):
    one = lambda n, e, q: spark.range(1).select(bqsr.empirical_quality(F.lit(n), F.lit(e), F.lit(q))).first()[0]
    assert one(1_000_000, 1000, 30.0) == 30.0
    counts = [100 if q in (10, 20, 30) else 0 for q in range(94)]
    got = bqsr.quantize(counts, 4)
    assert len(got) == 94 and len(set(got)) <= 4


def test_apply_qualities(spark):
    tables = spark.createDataFrame([("rg", 30, "Quality", "", 1_000_000, 316)], "rg string, qual int, covariate string, value string, observations long, errors long")
    rows = spark.createDataFrame([("rg", 0, "AAA", [30, 30, 5])], "rg string, flag int, seq string, qual array<int>")
    got = bqsr.recalibrate(rows, tables).first()["qual"]
    assert got[2] == 5 and got[0] == got[1] and got[0] in (34, 35)


def test_windows(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 500, 600), (1, 5000, 5100), (2, 1, 40), (2, 50, 90), (2, 95, 130), (2, 131, 140)], "contig long, start long, end long")
    windows = lambda *x: sorted(map(tuple, intervals.coalesce_windows(df, *x).collect()))
    assert windows() == [(1, 1, 600), (1, 5000, 5100), (2, 1, 140)]
    assert windows(1000, 100)[-2:] == [(2, 1, 90), (2, 95, 140)] and windows(1000, 101)[1:3] == [(1, 500, 600), (1, 5000, 5100)]

"""Reference bins, left-normalised indels, reads of regions, haplotype offsets and genotypes, against plain Python."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lociframe.functions import cigar as C
from lociframe.operators import reads, reference, regions
from lociframe.sources import blocks


def fasta(tmp_path, seed=1):
    rng = random.Random(seed)
    seqs = {"chr1": "".join(rng.choice("ACGTacgtN") for _ in range(9000)), "chr2": "ACAC" * 60 + "G" * 40 + "T", "empty": "", "chr3": "A"}
    rows = []
    for name, s in seqs.items():
        rows.append(f">{name} some text")
        width = rng.choice([7, 60, 61])
        rows += [s[i : i + width] for i in range(0, len(s), width)] + [""] * rng.randrange(2)
    path = tmp_path / "a.fa"
    path.write_text("\n".join(rows) + "\n")
    return str(path), {k: v.upper() for k, v in seqs.items() if v}


def test_bins_and_index(spark, tmp_path):
    path, seqs = fasta(tmp_path)
    lines = blocks.read_lines(spark, path, 700)
    got = {(r["contig"], r["bin"]): (r["start"], r["bases"]) for r in reference.bins(lines, 500, 64).collect()}
    assert got == {(c, b): (b * 500, s[b * 500 : b * 500 + 564]) for c, s in seqs.items() for b in range((len(s) - 1) // 500 + 1)}
    index = {r["contig"]: r for r in reference.index(lines).collect()}
    assert {c: r["length"] for c, r in index.items()} == {c: len(s) for c, s in seqs.items()}
    raw = open(path, "rb").read()
    assert all(raw[r["offset"] :].upper().startswith(seqs[c][: r["line_bases"]].encode()) for c, r in index.items())
    (tmp_path / "bad.fa").write_text("ACGT\n>x\nAC\n")
    with pytest.raises(Exception, match="before a header"):
        reference.bins(blocks.read_lines(spark, str(tmp_path / "bad.fa"))).collect()


def test_header_at_the_offset_of_its_first_line(spark):
    """As reference lines made of orders have it for key 0."""
    rows = [(10**12 * c + 64 * i, v) for c in range(2) for i, v in [(0, "ACGT"), (1, "TT"), (0, f">c{c}")]]
    for order in (rows, rows[::-1]):
        lines = spark.createDataFrame([("p", *r) for r in order], "path string, offset long, value string").coalesce(1)
        assert sorted((r["contig"], r["bases"]) for r in reference.bins(lines).collect()) == [("c0", "ACGTTT"), ("c1", "ACGTTT")]
        assert sorted(tuple(r) for r in reference.index(lines).collect()) == [("c0", 0, 6, 0, 4), ("c1", 10**12, 6, 10**12, 4)]


def test_lookups(spark, tmp_path):
    path, seqs = fasta(tmp_path)
    table = reference.bins(blocks.read_lines(spark, path), 500, 64)
    rows = [("chr1", 1, 64), ("chr1", 490, 553), ("chr1", 8990, 9050), ("chr1", 20, 19), ("chr2", -3, 2), ("chrX", 1, 5), ("chr3", 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "contig string, a int, b int")
    got = {(r["contig"], r["a"]): r["w"] for r in reference.with_bases(df, table, F.col("a"), F.col("b"), "w", 500, 64).collect()}
    assert got == {(c, a): seqs[c][max(a, 1) - 1 : b] if c in seqs else None for c, a, b in rows}
    with pytest.raises(Exception, match="more than 64"):
        reference.with_bases(df.withColumn("b", F.col("a") + 64), table, F.col("a"), F.col("b"), "w", 500, 64).collect()


def normalized(seq, pos, ref, alt):
    """By whole sequences: trims, then steps left while the last bases are equal."""
    if len(ref) == len(alt):
        return pos, ref, alt
    while min(len(ref), len(alt)) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while min(len(ref), len(alt)) > 1 and ref[0] == alt[0]:
        pos, ref, alt = pos + 1, ref[1:], alt[1:]
    while ref[-1] == alt[-1] and pos > 1 and seq[pos - 2] in "ACGT":
        base = seq[pos - 2]
        pos, ref, alt = pos - 1, base + ref[:-1], base + alt[:-1]
    return pos, ref, alt


def test_left_normalized(spark, tmp_path):
    rng = random.Random(4)
    path, seqs = fasta(tmp_path)
    table = reference.bins(blocks.read_lines(spark, path), 500, 310)
    rows = []
    for i in range(300):
        c = rng.choice(["chr1", "chr2"])
        pos = rng.randrange(1, len(seqs[c]) - 12)
        n, t = rng.randrange(1, 5), rng.choice([0, 0, 3])
        w = seqs[c][pos - 1 : pos + 11]
        ref, alt = (w[: n + 1 + t], w[0] + w[n + 1 : n + 1 + t]) if i % 2 else (w[: 1 + t], w[0] + (w[1 : n + 1] if i % 3 else "ACGT"[:n]) + w[1 : 1 + t])
        rows.append((i, c, pos, ref, alt))
    rows += [(900, "chr1", 50, "A", "C"), (901, "chrX", 5, "AA", "A"), (902, "chr1", 60, "CG", "TA")]
    got = {r["id"]: r for r in reference.left_normalize(spark.createDataFrame(rows, "id int, contig string, pos long, ref string, alt string"), table, 300, 500, 310).collect()}
    for i, c, pos, ref, alt in rows:
        assert (got[i]["pos"], got[i]["ref"], got[i]["alt"]) == normalized(seqs.get(c, "N" * 100), pos, ref, alt), (i, c, pos, ref, alt)
    assert not any(r["open"] for r in got.values()) and any(r["pos"] < rows[i][2] - 5 for i, r in got.items() if i < 300)
    # a repeat longer than the reach goes on from where it stopped
    once = reference.left_normalize(spark.createDataFrame([(1, "chr2", 200, "CA", "C")], "id int, contig string, pos long, ref string, alt string"), table, 50, 500, 310)
    assert [(r["pos"], r["open"]) for r in once.collect()] == [(200, False)] or once.first()["open"]
    long = reference.left_normalize(spark.createDataFrame([(1, "chr2", 199, "ACA", "A")], "id int, contig string, pos long, ref string, alt string"), table, 50, 500, 310).first()
    assert long["open"] and long["pos"] == 149


def walk(cigar):
    """(reference offset, read offset) of aligned bases."""
    out, r, q = [], 0, 0
    for n, op in ((int(n), o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
        if op in "M=X":
            out += [(r + i, q + i) for i in range(n)]
        r += n * (op in "MDN=X")
        q += n * (op in "MIS=X")
    return out


def random_cigar(rng):
    return "".join(f"{rng.randrange(1, 9)}{o}" for o in [*rng.sample(["H"], rng.randrange(2)), *rng.sample(["S"], rng.randrange(2)), "M", *rng.choices("MIDN=X", k=rng.randrange(6)), rng.choice("M=X"), *rng.sample(["S"], rng.randrange(2)), *rng.sample(["H"], rng.randrange(2))])


def test_pieces_offsets_and_evidence_over_random_cigars(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        cigar = random_cigar(rng)
        n = sum(int(k) for k, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar) if o in "MIS=X")
        rows.append((i, 0, "c", rng.randrange(3000), 60, cigar, "".join(rng.choice("ACGT") for _ in range(n)), [rng.choice([2, 5, 20, 30]) for _ in range(n)], rng.randrange(-2, 30)))
    df = spark.createDataFrame(rows, "read int, flag int, contig string, pos long, mapq int, cigar string, seq string, qual array<int>, at int")
    got = {}
    for r in reads.aligned(df, "read").where("not is_del").collect():
        got.setdefault(r["read"], []).append((r["pos"], r["qpos"], r["base"], r["qual"]))
    ops = C.ops(F.col("cigar"))
    picked = df.select("read", regions.offset_at(ops, F.col("pos") + 1, F.col("pos") + 1 + F.col("at")).alias("o"), regions.evidence_span(ops, F.col("qual")).alias("a"), regions.evidence_span(ops, F.col("qual"), True).alias("b")).collect()
    known = [(p,) for p in range(0, 3100, 7)]
    sites = spark.createDataFrame(known, "pos long").withColumn("contig", F.lit("c"))
    free = {}
    cut = reads.bases_of(reads.masked(reads.pieces(df, "read", "contig"), sites, 64), "read", "known_at").where("not is_del and (known_at is null or not array_contains(known_at, pos))")
    for r in cut.collect():
        free.setdefault(r["read"], []).append((r["pos"], r["qpos"], r["base"], r["qual"]))
    for i, _, _, pos, _, cigar, seq, qual, at in rows:
        want = [(pos + 1 + r, q, seq[q], qual[q]) for r, q in walk(cigar)]
        assert sorted(got[i]) == want
        assert sorted(free.get(i, [])) == [x for x in want if x[0] % 7]
        row = next(r for r in picked if r["read"] == i)
        assert row["o"] == dict(walk(cigar)).get(at)
        for name, kinds in (("a", "MI=X"), ("b", "MI=XS")):
            places, q = [], 0
            for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
                places += range(q, q + int(n)) if o in kinds else []
                q += int(n) * (o in "MIS=X")
            span = range(places[0], places[-1] + 1)
            good = [q for q in span if qual[q] >= 9]
            want = (good[0], good[-1] + 1) if good and good[-1] + 1 - good[0] >= 10 else None
            assert (tuple(row[name]) if row[name] else None) == want


def test_region_reads_with_a_hot_start(spark):
    rows = [(i, "c", 100 if i % 3 else i, (100 if i % 3 else i) + 40 + i % 5, i * 7 % 1001) for i in range(400)]
    df = spark.createDataFrame(rows, "read int, contig string, start long, end long, ordinal long").repartition(5)
    areas = [(1, "c", 90, 120), (2, "c", 130, 500), (3, "d", 1, 500)]
    got = regions.region_reads(df, spark.createDataFrame(areas, "region int, contig string, start long, end long"), per_start=20, salts=4).collect()
    want = set()
    for region, contig, a, b in areas:
        met = [r for r in rows if r[1] == contig and r[2] <= b and a <= r[3]]
        for r in met:
            want.add((region, r[0], sum(x[2] == r[2] and x[4] < r[4] for x in met) < 20))
    assert {(r["region"], r["read"], r["for_assembly"]) for r in got} == want and len(got) == len(want)


def test_events_and_genotypes(spark):
    """Three regions: a heterozygote, a homozygote and one without any read that tells."""
    events = spark.createDataFrame([(1, 0, 100, "A", "C"), (1, 1, 101, "AT", "A"), (1, 2, 103, "G", "T"), (2, 0, 50, "AAA", "A"), (3, 0, 10, "A", "C")], "region int, event int, pos long, ref string, alt string")
    rivals = {(r["region"], r["event"]): r["rivals"] for r in regions.overlapping_events(events).collect()}
    assert rivals == {(1, 0): [], (1, 1): [], (1, 2): [], (2, 0): [], (3, 0): []}
    close = spark.createDataFrame([(1, 0, 100, "AAA", "A"), (1, 1, 102, "AT", "A"), (1, 2, 103, "G", "T"), (2, 0, 102, "A", "C")], "region int, event int, pos long, ref string, alt string")
    assert {(r["region"], r["event"]): r["rivals"] for r in regions.overlapping_events(close).collect()} == {(1, 0): [1], (1, 1): [0, 2], (1, 2): [1], (2, 0): []}
    haps = spark.createDataFrame([(g, x) for g in (1, 2, 3) for x in (0, 1)], "region int, hap int")
    carriers = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (2, 0, 1), (3, 0, 1)], "region int, event int, hap int")
    spans = spark.createDataFrame([(g, r, 1, 99 if r == 9 else 200, r % 2 == 0) for g in (1, 2, 3) for r in range(10)], "region int, read int, start long, end long, reverse boolean")
    value = lambda g, r, x: -0.1 if (x == 1) == (g == 2 or r < 5) else -6.0
    scores = spark.createDataFrame([(g, r, x, -1.0 if g == 3 else value(g, r, x)) for g in (1, 2, 3) for r in range(10) for x in (0, 1)], "region int, read int, hap int, score double")
    alleles = regions.allele_scores(scores, haps, carriers, events, spans)
    counts = {(r["region"], r["event"]): (r["depth"], r["ref_count"], r["alt_count"]) for r in regions.support(alleles).collect()}
    assert counts[1, 0] == (9, 4, 5) and counts[1, 1] == (9, 9, 0) and counts[2, 0] == (10, 0, 10) and counts[3, 0] == (0, 0, 0)
    calls = {(r["region"], r["event"]): r for r in regions.genotype_events(alleles).collect()}
    assert set(calls) == {(1, 0), (2, 0)} and calls[1, 0]["genotype"] == 1 and calls[2, 0]["genotype"] == 2
    het = sum(math.log10(10**-0.1 + 10**-6) - math.log10(2) for _ in range(9)) + math.log10(1e-3)
    ref = -0.1 * 4 - 6 * 5 + math.log10(1 - 1.5e-3)
    assert calls[1, 0]["qual"] == round(-10 * (ref - het)) and calls[1, 0]["pl"][1] == 0
    pairs = regions.pair_scores(scores, haps).collect()
    assert len(pairs) == 9 and {(r["region"], r["first"], r["second"]) for r in pairs if r["rank"] == 1} == {(1, 0, 1), (2, 1, 1), (3, 0, 0)}

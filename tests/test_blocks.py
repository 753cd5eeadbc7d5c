"""Block-compressed text and binary alignments, cut into many ranges, against the whole text."""

import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from lociframe.sources import alignments, blocks, text

HEADER = "@HD\tVN:1.6\tSO:{}\n@SQ\tSN:chr1\tLN:100000\n@SQ\tSN:chr2\tLN:90000\n@RG\tID:r1\tSM:s\n"


def written(path, data, size):
    with open(path, "wb") as f:
        for at in range(0, len(data), size):
            f.write(blocks.compress(data[at : at + size]))
        f.write(blocks.END_BLOCK)
    return str(path)


@pytest.mark.parametrize("ending", ["\n", ""])
@pytest.mark.parametrize("size", [7, 100, 3000])
def test_lines_of_blocks(spark, tmp_path, size, ending):
    rng = random.Random(size)
    rows = ["x" * rng.choice([0, 1, 5, 40, 400]) + str(i) for i in range(300)] + ["", "é end"]
    data = ("\n".join(rows) + ending).encode()
    (tmp_path / "plain.txt").write_bytes(data)
    # several gzip members: as blocks, and as plain members
    half = len(data) // 2
    (tmp_path / "members.gz").write_bytes(gzip.compress(data[:half]) + gzip.compress(data[half:]))
    for path in (written(tmp_path / "a.bgz", data, size), str(tmp_path / "plain.txt"), str(tmp_path / "members.gz")):
        for split in (50, 1000, 1 << 20):
            df = blocks.read_lines(spark, path, split)
            got = df.collect()
            assert [r["value"] for r in sorted(got, key=lambda r: r["offset"])] == rows, (path, split)
            assert len({r["offset"] for r in got}) == len(rows)
    assert blocks.read_lines(spark, str(tmp_path / "a.bgz"), 200).rdd.getNumPartitions() > 3


def test_first_block_is_not_taken_from_content(spark, tmp_path):
    """A stored block whose content looks like a header."""
    fake = blocks.compress(b"fake") * 50
    rows = [fake.hex(), *(str(i) for i in range(2000))]
    path = written(tmp_path / "a.bgz", "\n".join(rows).encode(), 900)
    assert sorted(r["value"] for r in blocks.read_lines(spark, path, 64).collect()) == sorted(rows)


def test_a_broken_block_is_an_error(spark, tmp_path):
    path = written(tmp_path / "a.bgz", b"some text\n" * 100, 500)
    data = bytearray((tmp_path / "a.bgz").read_bytes())
    data[25] ^= 255
    (tmp_path / "a.bgz").write_bytes(data)
    with pytest.raises(Exception, match="block|decompress|checksum"):
        blocks.read_lines(spark, path).collect()
    with pytest.raises(Exception, match="missing"):
        blocks.read_lines(spark, str(tmp_path / "missing")).collect()


def sam_rows(n, seed=1, in_order=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        length = rng.choice([0, 1, 20, 35, 151])
        seq = "".join(rng.choice("ACGTN") for _ in range(length)) or "*"
        qual = "".join(chr(33 + rng.randrange(60)) for _ in range(length)) if length and rng.random() < 0.9 else "*"
        contig, pos = (rng.choice(["chr1", "chr2"]), rng.randrange(1, 80000)) if rng.random() < 0.9 else ("*", 0)
        cigar = f"{length - 5}M3I2S" if length > 20 else f"{length}M" if length else "*"
        mate, mate_pos = rng.choice([("=", 77), ("*", 0), ("chr2", 5)]) if contig != "*" else ("*", 0)
        tags = rng.sample([f"NM:i:{rng.randrange(-9, 9)}", "RG:Z:r1", "XZ:Z:a b:c", "MD:Z:5^AC3", "XE:Z:"], rng.randrange(5))
        rows.append([f"read{i}/{'x' * rng.randrange(30)}", rng.choice([0, 16, 99, 147, 4, 2048]), contig, pos, rng.randrange(61), cigar, mate, mate_pos, rng.randrange(-500, 500), seq, qual, *tags])
    if in_order:
        rows.sort(key=lambda r: (r[2] == "*", r[2], r[3]))
    return ["\t".join(map(str, r)) for r in rows]


def table(df):
    return sorted(str(r.asDict(True) | {"tags": sorted((r["tags"] or {}).items())}) for r in df.collect())


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bam")
    header = HEADER.format("unsorted")
    (folder / "a.sam").write_text(header + "\n".join(sam_rows(700)) + "\n")
    sam = text.sam(spark, str(folder / "a.sam"))
    alignments.write_bam(sam.repartition(2), header, str(folder / "out"), content=600)
    return folder, sam


def test_every_range_finds_its_first_record(tmp_path):
    """Ranges of single bytes up to several blocks, read without Spark; a range below a block's size often holds no block."""
    rows = []
    for line in sam_rows(150, 5):
        f = line.split("\t")
        qual = [ord(c) - 33 for c in f[10]] if f[10] != "*" else []
        mate = f[2] if f[6] == "=" else f[6]
        of = lambda c: None if c == "*" else c
        rows.append(dict(qname=f[0], flag=int(f[1]), contig=of(f[2]), pos=int(f[3]) - 1, mapq=int(f[4]), cigar=f[5], mate_contig=of(mate), mate_pos=int(f[7]) - 1, tlen=int(f[8]), seq=f[9], qual=qual, tags=[(x[:2], x[5:]) for x in f[11:]]))
    numbers, head = {"chr1": 0, "chr2": 1}, HEADER.format("unsorted").encode()
    data = b"BAM\1" + struct.pack("<i", len(head)) + head + struct.pack("<i", 2) + b"".join(struct.pack("<i", 5) + c.encode() + b"\0" + struct.pack("<i", 100000) for c in numbers)
    data += b"".join(alignments.encode(r, numbers) for r in rows)
    columns = list(rows[0])
    for size, split in ((50, 40), (300, 100), (600, 300), (5000, 7000)):
        path, got = written(tmp_path / f"{size}.bam", data, size), []
        for r in blocks.ranges(path, split):
            for out in alignments.records(r, columns, alignments.Wanted()):
                got += [dict(zip(columns, x, strict=True)) for x in zip(*out.values(), strict=True)]
        assert got == rows, (size, split)


def test_alignments_equal_the_sam_text(spark, both):
    folder, sam = both
    files = [f for f, _ in blocks.listed(str(folder / "out"))]
    assert len(files) == 2 and not (folder / "out" / "_open").exists()
    for split in (1500, 9000, 1 << 20):
        bam = alignments.read_bam(spark, str(folder / "out"), split=split)
        assert bam.rdd.getNumPartitions() >= (20 if split == 1500 else 2)
        assert table(bam) == table(sam)
    assert [r["value"] for r in alignments.header_lines(spark, str(folder / "out")).collect()] == HEADER.format("unsorted").splitlines()


def test_alignment_columns_and_filters(spark, both):
    folder, sam = both
    bam = alignments.read_bam(spark, str(folder / "out"), ["contig", "pos", "qname"], split=4000)
    assert bam.columns == ["contig", "pos", "qname"]
    found = bam.where("contig = 'chr2' and pos >= 1000 and pos < 50000 and length(qname) > 12")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "contig" not in plan.split("Filter")[1].split("BatchScan")[0].replace("isnotnull(contig", "")
    want = sam.where("contig = 'chr2' and pos >= 1000 and pos < 50000 and length(qname) > 12").select("contig", "pos", "qname")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and want.count() > 50
    assert bam.where(F.col("contig").isin("chr1")).count() == sam.where("contig = 'chr1'").count()
    assert bam.where("contig = 'chrX'").count() == 0 and bam.where("contig is null").count() == sam.where("contig is null").count()


def test_sorted_alignments_end_early_and_empty_ones(spark, tmp_path):
    header = HEADER.format("coordinate")
    (tmp_path / "a.sam").write_text(header + "\n".join(sam_rows(300, 2, True)) + "\n")
    sam = text.sam(spark, str(tmp_path / "a.sam")).coalesce(1)
    alignments.write_bam(sam, header, str(tmp_path / "out"), content=500)
    assert alignments.read_bam(spark, str(tmp_path / "out"), split=700).where("contig = 'chr1'").count() == sam.where("contig = 'chr1'").count()
    alignments.write_bam(sam.limit(0), header, str(tmp_path / "out"))
    assert alignments.read_bam(spark, str(tmp_path / "out")).count() == 0
    with pytest.raises(Exception, match="qualities"):
        alignments.write_bam(sam.withColumn("qual", F.array(F.lit(1))).where("length(seq) > 1"), header, str(tmp_path / "bad"))
    assert not [f for f in (tmp_path / "bad").rglob("*.bam")]


def test_vcf_of_blocks(spark, tmp_path):
    rows = [f"chr{1 + i % 2}\t{i * 10 + 1}\t.\tA\tC,G\t{i}\tPASS\tDP={i}\tGT:DP\t0/1:{i}" for i in range(400)]
    data = "\n".join(["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS", *rows]) + "\n"
    path = written(tmp_path / "a.vcf.bgz", data.encode(), 700)
    (tmp_path / "a.vcf").write_text(data)
    got, want = (text.vcf(spark, p, split=900) for p in (path, str(tmp_path / "a.vcf")))
    assert got.columns[:5] == ["chrom", "pos", "id", "ref", "alt"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 800

"""Binary alignment files (BAM) as a table and back, by Spark's Python data source API.

A file is cut into byte ranges. A task finds its first block, then its first record: a place from which several records in
a row are sound in every field whose values the format bounds. It returns the records that begin in its blocks, so each
belongs to one task. Only the columns of the read schema are decoded, and comparisons of contig and pos are applied
to the fixed fields before anything else of a record is touched; in a file sorted by coordinate a task ends at the
first record beyond them. Writing makes one file for each task; files count once the job commits.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from lociframe.sources.blocks import END_BLOCK, Range, blocks, compress, ranges

SCHEMA = "qname string, flag int, contig string, pos long, mapq int, cigar string, mate_contig string, mate_pos long, tlen int, seq string, qual array<int>, tags map<string,string>"
#: Fixed values of the format.
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
FIXED = struct.Struct("<iiiBBHHHiiii")
ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "map<string,string>": pa.map_(pa.string(), pa.string())}
PAIRS = np.array([list((a + b).encode()) for a in BASES for b in BASES], dtype=np.uint8)
#: Records in a row that must be sound where a task starts.
SOUND = 5
#: A block's content when writing; the largest record that is believed.
CONTENT, RECORD = 60_000, 1 << 26
BATCH = 4096


@dataclass
class Wanted:
    """Records to keep, by the filters that Spark pushes down."""

    contigs: set[str] | None = None
    least: int = -1
    most: int = 1 << 31

    def take(self, f: Filter) -> bool:
        """Whether f is one that is applied here, whole."""
        if isinstance(f, (EqualTo, In)) and f.attribute == ("contig",):
            some = set(f.value) if isinstance(f, In) else {f.value}
            self.contigs = some if self.contigs is None else self.contigs & some
        elif f.__class__ in (GreaterThan, GreaterThanOrEqual) and f.attribute == ("pos",):
            self.least = max(self.least, f.value + isinstance(f, GreaterThan))
        elif f.__class__ in (LessThan, LessThanOrEqual) and f.attribute == ("pos",):
            self.most = min(self.most, f.value - isinstance(f, LessThan))
        else:
            return False
        return True


@dataclass
class Header:
    text: str
    names: list[str]
    lengths: list[int]
    size: int = 0
    in_order: bool = field(init=False)

    def __post_init__(self):
        self.in_order = bool(re.search(r"^@HD\t.*\bSO:coordinate", self.text))


class Stream:
    """The content of a range's blocks as one growing buffer; `own` bytes of it are the range's."""

    def __init__(self, r: Range):
        self.source, self.data, self.own, self.ended = blocks(r), bytearray(), 0, False

    def need(self, n: int) -> bool:
        """Fills the buffer to n bytes, if the file has them."""
        while len(self.data) < n and not self.ended:
            self.more()
        return len(self.data) >= n

    def more(self) -> bool:
        """Adds a block; whether it is the range's."""
        item = next(self.source, None)
        if item is None:
            self.ended = True
            return False
        _, data, own = item
        self.data += data
        if own:
            self.own = len(self.data)
        return own

    def owns(self, at: int) -> bool:
        while at >= self.own and self.more():
            pass
        return at < self.own

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.own -= n


def read_header(path: str, kind: str = "bgzf") -> Header:
    s = Stream(Range(path, 0, 1 << 62, _size(path), kind))
    if not s.need(12) or s.data[:4] != b"BAM\1":
        raise ValueError(f"not a binary alignment file: {path}")
    n = struct.unpack_from("<i", s.data, 4)[0]
    s.need(12 + n)
    text = bytes(s.data[8 : 8 + n]).rstrip(b"\0").decode()
    count, at, names, lengths = struct.unpack_from("<i", s.data, 8 + n)[0], 12 + n, [], []
    for _ in range(count):
        s.need(at + 4)
        k = struct.unpack_from("<i", s.data, at)[0]
        s.need(at + 8 + k)
        names.append(bytes(s.data[at + 4 : at + 3 + k]).decode())
        lengths.append(struct.unpack_from("<i", s.data, at + 4 + k)[0])
        at += 8 + k
    return Header(text, names, lengths, at)


def _size(path: str) -> int:
    fs, at = pafs.FileSystem.from_uri(path)
    return fs.get_file_info(at).size


def sound(s: Stream, at: int, header: Header) -> int:
    """Where the record at this place ends, 0 if there can be none."""
    if not s.need(at + 36):
        return 0
    size, ref, pos, name, _, _, n_ops, flag, length, mate, mate_pos, _ = FIXED.unpack_from(s.data, at)
    n = len(header.names)
    fits = lambda r, p: -1 <= r < n and -1 <= p <= (header.lengths[r] if r >= 0 else 1 << 30)
    if not (32 <= size <= RECORD and fits(ref, pos) and fits(mate, mate_pos) and name >= 1 and 0 <= length and flag < 1 << 12 and 32 + name + 4 * n_ops + (length + 1) // 2 + length <= size):
        return 0
    if not s.need(at + 36 + name + 4 * n_ops):
        return 0
    text = s.data[at + 36 : at + 36 + name]
    ops = s.data[at + 36 + name : at + 36 + name + 4 * n_ops : 4]
    if text[-1] != 0 or any(c < 33 or c > 126 for c in text[:-1]) or any(c & 15 > 8 for c in ops):
        return 0
    return at + 4 + size


def first_record(s: Stream, header: Header) -> int | None:
    """The place of the range's first record, None if none begins in it."""
    at = 0
    while True:
        if not s.owns(at):
            return None
        end, k = at, 0
        while k < SOUND:
            end, k = sound(s, end, header), k + 1
            if not end:
                break
            if not s.need(end + 1) and end == len(s.data):  # the file's last record
                return at
        if end:
            return at
        at += 1


def _tags(data: memoryview) -> list[tuple[str, str]]:
    out, at = [], 0
    while at + 3 <= len(data):
        name, kind = bytes(data[at : at + 2]).decode(), chr(data[at + 2])
        at += 3
        if kind == "A":
            value, at = chr(data[at]), at + 1
        elif kind in NUMBERS:
            number = struct.unpack_from("<" + NUMBERS[kind], data, at)[0]
            value, at = f"{number:g}" if kind == "f" else str(number), at + struct.calcsize(NUMBERS[kind])
        elif kind in "ZH":
            end = bytes(data[at:]).index(0) + at
            value, at = bytes(data[at:end]).decode(), end + 1
        elif kind == "B":
            each, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            numbers = struct.unpack_from(f"<{n}{NUMBERS[each]}", data, at + 5)
            value, at = ",".join([each, *(f"{x:g}" if each == "f" else str(x) for x in numbers)]), at + 5 + n * struct.calcsize(NUMBERS[each])
        else:
            raise ValueError(f"unknown type {kind} of tag {name}")
        out.append((name, value))
    return out


def records(r: Range, columns: list[str], wanted: Wanted) -> Iterator[dict[str, list]]:
    """The range's records as columns, a batch at a time."""
    header = read_header(r.path)
    numbers = None if wanted.contigs is None else {k for k, n in enumerate(header.names) if n in wanted.contigs}
    last = None if numbers is None or not header.in_order else max(numbers, default=-1)
    s = Stream(r)
    if r.start == 0:
        s.need(header.size)
        s.drop(header.size)
    else:
        at = first_record(s, header)
        if at is None:
            return
        s.drop(at)
    name_of = lambda k: header.names[k] if k >= 0 else None
    out: dict[str, list] = {c: [] for c in columns}
    n, at = 0, 0
    while s.owns(at):
        if not s.need(at + 4):
            raise ValueError(f"{r.path} ends inside a record")
        size = struct.unpack_from("<i", s.data, at)[0]
        if not s.need(at + 4 + size):
            raise ValueError(f"{r.path} ends inside a record")
        _, ref, pos, name, mapq, _, n_ops, flag, length, mate, mate_pos, tlen = FIXED.unpack_from(s.data, at)
        begin, at = at, at + 4 + size
        if last is not None and (ref > last or ref < 0):
            break
        if (numbers is None or ref in numbers) and wanted.least <= pos <= wanted.most:
            body = memoryview(bytes(s.data[begin + 36 : at]))
            q = name + 4 * n_ops
            packed = (length + 1) // 2
            for c, column in out.items():
                if c == "qname":
                    value = bytes(body[: name - 1]).decode()
                elif c == "flag":
                    value = flag
                elif c == "contig":
                    value = name_of(ref)
                elif c == "pos":
                    value = pos
                elif c == "mapq":
                    value = mapq
                elif c == "cigar":
                    value = "".join(f"{x >> 4}{OPS[x & 15]}" for x in struct.unpack_from(f"<{n_ops}I", body, name)) or "*"
                elif c == "mate_contig":
                    value = name_of(mate)
                elif c == "mate_pos":
                    value = mate_pos
                elif c == "tlen":
                    value = tlen
                elif c == "seq":
                    value = PAIRS[np.frombuffer(body, np.uint8, packed, q)].tobytes()[:length].decode() if length else "*"
                elif c == "qual":
                    value = list(body[q + packed : q + packed + length]) if length and body[q + packed] != 255 else []
                else:
                    value = _tags(body[q + packed + length :])
                column.append(value)
            n += 1
            if n == BATCH:
                yield out
                out, n = {c: [] for c in columns}, 0
        if at > 1 << 20:
            s.drop(at)
            at = 0
    yield out


class AlignmentReader(DataSourceReader):
    def __init__(self, path: str, split: int, schema: StructType):
        self.path, self.split, self.wanted = path, split, Wanted()
        self.columns = {f.name: ARROW[f.dataType.simpleString()] for f in schema.fields}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def partitions(self) -> list[InputPartition]:
        return ranges(self.path, self.split) or [Range(self.path, 0, 0, 0, "none")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for out in records(partition, list(self.columns), self.wanted) if partition.kind != "none" else ():
            yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in self.columns.items()], names=list(self.columns))


def bin_of(start: int, end: int) -> int:
    """The smallest of the format's bins (16 KB to 512 MB, by powers of 8) that holds the half-open span."""
    last = end - 1
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if start >> shift == last >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (start >> shift)
    return 0


def encode(row: dict, numbers: dict[str, int]) -> bytes:
    """A row of SCHEMA as a record. Tags are texts, so whole numbers are stored as such and all else as text."""
    ops = [(int(n), OPS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", row["cigar"] or "")]
    seq = "" if row["seq"] in (None, "*") else row["seq"].upper()
    codes = [BASES.find(c) if c in BASES else 15 for c in seq] + [0] * (len(seq) % 2)
    name = (row["qname"] or "*").encode() + b"\0"
    span = max(1, sum(n for n, o in ops if OPS[o] in "MDN=X"))
    qual = bytes(row["qual"]) if row["qual"] else b"\xff" * len(seq)
    if len(qual) != len(seq):
        raise ValueError(f"{len(qual)} qualities of {len(seq)} bases: {row['qname']}")
    tags = b""
    for key, value in row["tags"] or []:
        small = re.fullmatch(r"-?\d{1,9}", value or "")
        tags += key.encode() + (b"i" + struct.pack("<i", int(value)) if small and str(int(value)) == value else b"Z" + (value or "").encode() + b"\0")
    pos = -1 if row["pos"] is None else row["pos"]
    body = name + b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2], strict=True)) + qual + tags
    number = lambda c: numbers[row[c]] if row[c] is not None else -1
    bin_number = bin_of(pos, pos + span) if pos >= 0 else 4680
    return FIXED.pack(32 + len(body), number("contig"), pos, len(name), row["mapq"] or 0, bin_number, len(ops), row["flag"], len(seq), number("mate_contig"), -1 if row["mate_pos"] is None else row["mate_pos"], row["tlen"] or 0) + body


@dataclass
class Written(WriterCommitMessage):
    name: str


class AlignmentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, header: str, content: int, overwrite: bool):
        self.path, self.header, self.content, self.overwrite = path, header, content, overwrite
        self.contigs = [(m[1], int(m[2])) for line in header.splitlines() if line.startswith("@SQ") and (m := re.search(r"\tSN:([^\t]+).*?\tLN:(\d+)", line))]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        fs, root = pafs.FileSystem.from_uri(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam"
        fs.create_dir(f"{root}/_open", recursive=True)
        numbers = {c: k for k, (c, _) in enumerate(self.contigs)}
        text = self.header.encode()
        data = bytearray(b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.contigs)))
        for contig, length in self.contigs:
            data += struct.pack("<i", len(contig) + 1) + contig.encode() + b"\0" + struct.pack("<i", length)
        with fs.open_output_stream(f"{root}/_open/{name}", compression=None) as f:
            for b in iterator:
                for row in b.to_pylist():
                    data += encode(row, numbers)
                    while len(data) >= self.content:
                        f.write(compress(bytes(data[: self.content])))
                        del data[: self.content]
            while data:
                f.write(compress(bytes(data[: self.content])))
                del data[: self.content]
            f.write(END_BLOCK)
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root)):
                if f.type == pafs.FileType.File:
                    fs.delete_file(f.path)
        for m in messages:
            if m is not None:
                fs.move(f"{root}/_open/{m.name}", f"{root}/{m.name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        if fs.get_file_info(f"{root}/_open").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_open")


class AlignmentSource(DataSource):
    """Options: path; reading: split (bytes of a task's range); writing: header (SAM header text with @SQ lines), content (bytes of a block)."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> AlignmentReader:
        return AlignmentReader(self.options["path"], int(self.options.get("split", 64 << 20)), schema)

    def writer(self, schema: StructType, overwrite: bool) -> AlignmentWriter:
        return AlignmentWriter(self.options["path"], self.options.get("header", ""), int(self.options.get("content", CONTENT)), overwrite)


def read_bam(spark: SparkSession, path: str, columns: list[str] | None = None, split: int = 64 << 20) -> DataFrame:
    """Records of a file, or of a folder's files, as `text.sam` gives them; only the named columns are decoded."""
    spark.dataSource.register(AlignmentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    kinds = dict(c.split(" ", 1) for c in SCHEMA.split(", "))
    schema = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("bam").schema(schema).option("split", split).load(path)


def write_bam(reads: DataFrame, header: str, path: str, mode: str = "overwrite", content: int = CONTENT) -> None:
    """reads (columns of SCHEMA) as one file for each task under path, in the order that they have."""
    spark = reads.sparkSession
    spark.dataSource.register(AlignmentSource)
    reads.select(*(c.split()[0] for c in SCHEMA.split(", "))).write.format("bam").option("header", header).option("content", content).mode(mode).save(path)


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """The header's lines (value), as `text.contigs` and `text.read_groups` read them from SAM text: one small partition, whatever the file's size."""
    texts = read_header(ranges(path, 1 << 62)[0].path).text.splitlines()
    return spark.createDataFrame([(x,) for x in texts], "value string")

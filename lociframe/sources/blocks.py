"""Files as byte ranges: text lines with their offsets, from plain, gzip or block-compressed (BGZF) files.

A block-compressed file is a row of gzip members of 64 KB at most, each with its own size in its header, so a task can
start in the middle: it looks for the first header at or after its range that is followed by another one. A line
belongs to the task whose blocks hold the newline before it; the task reads on beyond its range to finish it. Files
are opened by pyarrow's file systems (local paths, file:, hdfs:, s3: and others), by tasks and never whole.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAGIC = b"\x1f\x8b\x08\x04"
#: The empty block that ends a block-compressed file (a fixed value of the format).
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
LARGEST = 1 << 16
PLAIN = 1 << 16
BATCH_BYTES = 4 << 20


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int
    kind: str  # bgzf, gzip or plain


def opened(path: str):
    fs, at = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(at)


def listed(path: str) -> list[tuple[str, int]]:
    """Paths and sizes of a file, or of a folder's files that are not hidden, in order of name."""
    fs, at = pafs.FileSystem.from_uri(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    found = fs.get_file_info(pafs.FileSelector(at, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")) and "/_" not in f.path[len(at) :])


def block_size(data: bytes, at: int = 0) -> int:
    """Compressed size of the block whose header lies at this place, 0 if there is none."""
    if data[at : at + 4] != MAGIC or len(data) < at + 18:
        return 0
    extra = struct.unpack_from("<H", data, at + 10)[0]
    place, stop = at + 12, at + 12 + extra
    while place + 4 <= min(stop, len(data)):
        a, b, n = data[place], data[place + 1], struct.unpack_from("<H", data, place + 2)[0]
        if (a, b, n) == (66, 67, 2) and place + 6 <= len(data):
            return struct.unpack_from("<H", data, place + 4)[0] + 1
        place += 4 + n
    return 0


def kind_of(path: str) -> str:
    with opened(path) as f:
        head = f.read(18)
    return "bgzf" if block_size(head) else "gzip" if head[:2] == MAGIC[:2] else "plain"


def ranges(path: str, split: int) -> list[Range]:
    out = []
    for name, size in listed(path):
        kind = kind_of(name)
        step = max(size, 1) if kind == "gzip" else split
        out += [Range(name, at, min(size, at + step), size, kind) for at in range(0, size, step)]
    return out


def first_block(f, start: int, size: int) -> int:
    """Offset of the first block at or after start, size if there is none. It counts only if another block or the end follows it."""
    if start == 0:
        return 0
    f.seek(start)
    data = f.read(3 * LARGEST)
    at = data.find(MAGIC)
    while at >= 0:
        n = block_size(data, at)
        if n and (start + at + n == size or block_size(data, at + n)):
            return start + at
        at = data.find(MAGIC, at + 1)
    return size


def blocks(r: Range) -> Iterator[tuple[int, bytes, bool]]:
    """(key of the block's first byte, content, whether the range holds it), on beyond the range to the end of the file."""
    with opened(r.path) as f:
        if r.kind == "bgzf":
            at = first_block(f, r.start, r.size)
            while at < r.size:
                f.seek(at)
                data = f.read(LARGEST)
                n = block_size(data)
                if not n or n > len(data):
                    raise ValueError(f"broken block at {at} of {r.path}")
                extra = struct.unpack_from("<H", data, 10)[0]
                content = zlib.decompress(data[12 + extra : n - 8], -15)
                if zlib.crc32(content) != struct.unpack_from("<I", data, n - 8)[0]:
                    raise ValueError(f"wrong checksum of the block at {at} of {r.path}")
                yield at << 16, content, at < r.end
                at += n
        elif r.kind == "gzip":
            zip_, at = zlib.decompressobj(31), 0
            while data := f.read(PLAIN):
                while data:
                    content = zip_.decompress(data)
                    yield at, content, True
                    at += len(content)
                    data = zip_.unused_data
                    if zip_.eof:
                        zip_ = zlib.decompressobj(31)
        else:
            at = r.start
            f.seek(at)
            while data := f.read(min(PLAIN, r.end - at) if at < r.end else PLAIN):
                yield at, data, at < r.end
                at += len(data)


def lines(r: Range) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the range's lines: those after a newline that the range holds, and the file's first one."""
    begun: tuple[int, list[bytes]] | None = (0, []) if r.start == 0 else None
    for key, data, own in blocks(r):
        at = 0
        while (end := data.find(b"\n", at)) >= 0:
            if begun is not None:
                yield begun[0], b"".join([*begun[1], data[at:end]])
                begun = None
            if not own:
                return
            at = end + 1
            begun = (key + at, [])
        if begun is not None:
            begun[1].append(data[at:])
        elif not own:
            return
    if begun is not None and any(begun[1]):
        yield begun[0], b"".join(begun[1])


class LineReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[InputPartition]:
        return ranges(self.path, self.split) or [Range(self.path, 0, 0, 0, "none")]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(text, pa.string())], names=["path", "offset", "value"])

        at, text, size = [], [], 0
        for offset, line in lines(partition) if partition.kind != "none" else ():
            at.append(offset)
            text.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            size += len(line)
            if size > BATCH_BYTES:
                yield batch()
                at, text, size = [], [], 0
        yield batch()


class LineSource(DataSource):
    """Lines of a file or folder. Options: path, split (bytes of a task's range)."""

    @classmethod
    def name(cls) -> str:
        return "offset_lines"

    def schema(self) -> str:
        return "path string, offset long, value string"

    def reader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("split", 64 << 20)))


def read_lines(spark: SparkSession, path: str, split: int = 64 << 20) -> DataFrame:
    """path, offset, value of each line. The offset orders a file's lines: bytes, or for block-compressed files the block's place and the place in it."""
    spark.dataSource.register(LineSource)
    return spark.read.format("offset_lines").option("split", split).load(path)


def compress(data: bytes, level: int = 1) -> bytes:
    """One block: data of at most 65,280 bytes."""
    zip_ = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = zip_.compress(data) + zip_.flush()
    return MAGIC + struct.pack("<IBBHBBHH", 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))

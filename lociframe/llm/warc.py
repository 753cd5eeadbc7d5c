"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; each bundle ends in the seek table of the public seekable
format (a skippable frame with the sizes of all frames), and an index maps record identifiers to bundle, frame
and offset inside the frame. One record is read by decompressing one frame.

Payloads that repeat are stored once: the record with the largest page_id is the response, the others are
revisit records that name it. Writers run in Spark tasks and put their files under attempt-specific names in a
folder that all machines share; only files named by the committed index are read, so a task that failed or ran
twice leaves nothing that counts.

Defined cases: a null html is an empty payload, a null url an empty target; control characters in a url are
percent-encoded; a null page_id is the smallest; rows that repeat a page_id keep a record each, and if their payloads
are equal too and theirs is the largest, all of them are responses; an empty table gives no bundle and no rows; columns
other than page_id, url, html are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm import shared

FRAME_BYTES = 128 << 10
BUNDLE_BYTES = 16 << 20
MIN_REVISIT = 1000
BUNDLES_A_TASK = 8
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed values of the public seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = "record_id string, bundle string, frame int, offset long, length long"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """frames: compressed and decompressed size of each."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """From the last bytes of a bundle, all of its table at least."""
    n, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE or flags & 0x7F:
        raise ValueError("no seek table")
    return [struct.unpack_from("<II", tail, len(tail) - 9 - 8 * (n - i)) for i in range(n)]


def table_bytes(footer: bytes) -> int:
    """Size of the whole table, from the last nine bytes of a bundle."""
    return 8 + 8 * struct.unpack("<IBI", footer)[0] + 9


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, length: int, refers_to: int | None, revisit: bool) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=''.join(map(chr, range(33, 127))))}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {length}",
        "Content-Type: text/html;charset=utf-8",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    block = b"" if revisit else payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record: str) -> int | None:
    inner = record.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at `at`."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, n = end + 4, int(head["Content-Length"])
    return head, data[start : start + n], start + n + 4


def table_of(f: pa.NativeFile) -> list[tuple[int, int]]:
    """The seek table of an open bundle."""
    n = table_bytes(f.read_at(9, f.size() - 9))
    return read_seek_table(f.read_at(n, f.size() - n))


def frame_at(f: pa.NativeFile, at: int, small: int, large: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(f.read_at(small, at), max_output_size=large)


def frames_of(f: pa.NativeFile) -> Iterator[bytes]:
    """Each frame of an open bundle, decompressed on its own."""
    at = 0
    for small, large in table_of(f):
        yield frame_at(f, at, small, large)
        at += small


class Bundle:
    """A bundle being written: whole frames go out as they fill."""

    def __init__(self, fs: pafs.FileSystem, path: str, level: int):
        self.out, self.zip = fs.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.size = self.written = 0

    def add(self, data: bytes, frame_bytes: int) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.size and self.size + len(data) > frame_bytes:
            self.flush()
        at = len(self.frames), self.size
        self.open.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.open:
            data = self.zip.compress(b"".join(self.open))
            self.out.write(data)
            self.frames.append((len(data), self.size))
            self.written += len(data)
            self.open, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def dedup_plan(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, length, refers_to, revisit."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("length"), F.when(F.octet_length("payload") >= min_revisit, F.sha2("payload", 256)).alias("same"))
    repeated = rows.where(F.col("same").isNotNull()).groupBy("same").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1 and largest is not null").drop("n")
    # a merge join at every size: what repeats grows with the pages, so it is never broadcast
    # pages too small to revisit get a key of their own, so they spread over all tasks; Spark splits the key of a hot payload
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    joined = rows.withColumn("same", F.coalesce("same", own)).join(repeated.hint("merge"), "same", "left")
    revisit = F.coalesce(F.coalesce(F.col("page_id") < F.col("largest"), F.lit(True)) & F.col("largest").isNotNull(), F.lit(False))
    marked = joined.withColumn("revisit", revisit)
    return marked.select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "digest", "length", F.when(F.col("revisit"), F.col("largest")).alias("refers_to"), "revisit")


def write(plan: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3) -> DataFrame:
    """Rows of dedup_plan() as bundles in `folder`; returns the index. Writing happens when the index is computed, so store that once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        context = TaskContext.get()
        bundle, name, made = None, "", 0
        for b in batches:
            rows = {n: [] for n in ("record_id", "bundle", "frame", "offset", "length")}
            for page in b.to_pylist():
                if bundle and bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
                if not bundle:
                    name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{made:04d}.warc.zst"
                    bundle, made = Bundle(fs, f"{root}/{name}", level), made + 1
                data = record(page["page_id"], page["url"], page["payload"], page["digest"], page["length"], page["refers_to"], page["revisit"])
                frame, offset = bundle.add(data, frame_bytes)
                for column, x in zip(rows.values(), (record_id(page["page_id"]), name, frame, offset, len(data)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
        if bundle:
            bundle.close()

    return plan.select("page_id", "url", "payload", "digest", "length", "refers_to", "revisit").mapInArrow(run, INDEX)


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int"


def _page(head: dict[str, str], block: bytes) -> tuple:
    revisit = head["WARC-Type"] == "revisit"
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    return _page_id(head["WARC-Record-ID"]), int(head["X-Payload-Length"]) if revisit else len(block), digest, head["WARC-Type"], _page_id(head["WARC-Refers-To"]) if revisit else None


def _dealt(rows: DataFrame, n_bundles: int) -> int:
    """Tasks for that many bundles: BUNDLES_A_TASK each at most, and as many tasks as the session has partitions where there are bundles for them."""
    return max(1, -(-n_bundles // BUNDLES_A_TASK), min(n_bundles, shared.partitions(rows.sparkSession)))


def read(folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names, parsed from the archives frame by frame; one frame is in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32())
        for b in batches:
            for name in b.column("bundle").to_pylist():
                with fs.open_input_file(f"{root}/{name}") as f:
                    for k, data in enumerate(frames_of(f)):
                        rows, at = [], 0
                        while at < len(data):
                            head, block, at = parse(data, at)
                            rows.append((*_page(head, block), name, k))
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in PAGES.split(", ")])

    names = index.select("bundle").distinct()
    return names.repartition(_dealt(names, names.count())).mapInArrow(run, PAGES)


def fetch(index: DataFrame, folder: str, record_ids: DataFrame) -> DataFrame:
    """Single records by identifier: only the seek table and the frames that are asked for are read. record_ids: (record_id)."""
    n_bundles = index.select("bundle").distinct().count()
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id").repartition(_dealt(index, n_bundles), "bundle").sortWithinPartitions("bundle", "frame", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        have, frames, starts, data = None, [], [], b""
        for b in batches:
            found: list[tuple[str, bytes]] = []
            for r in b.to_pylist():
                if have != (r["bundle"], r["frame"]):
                    with fs.open_input_file(f"{root}/{r['bundle']}") as f:
                        if have is None or have[0] != r["bundle"]:
                            frames = table_of(f)
                            starts = list(itertools.accumulate((x for x, _ in frames), initial=0))
                        data = frame_at(f, starts[r["frame"]], *frames[r["frame"]])
                    have = (r["bundle"], r["frame"])
                found.append((r["record_id"], data[r["offset"] : r["offset"] + r["length"]]))
                if sum(len(x) for _, x in found[-64:]) > FRAME_BYTES * 8 or len(found) >= 1024:
                    yield _found(found)
                    found = []
            if found:
                yield _found(found)

    return wanted.select("record_id", "bundle", "frame", "offset", "length").mapInArrow(run, "record_id string, record binary")


def _found(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    names, blocks = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(blocks, pa.binary())], names=["record_id", "record"])

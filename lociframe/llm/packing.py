"""Packing of tokenized documents into training sequences by best-fit decreasing.

tokenize_pieces() turns each document into token ids and cuts it into full windows and one remainder; pack() deals
the pieces into partitions by salt and packs each partition: longest pieces first, each into the open window
with the least room that still holds it, which a segment tree indexed by remaining capacity finds in logarithmic
time. Only lengths and digests are shuffled, never ids or texts; sequences() joins the ids to a plan.

Words are tokenized once for each Python worker and kept in a bounded table. This is exact for a tokenizer whose
pre-tokenizer splits at white space and drops it, as no token then reaches over a space; each tokenizer is tried on probes first,
and without this rule whole texts are tokenized. With one whose own settings lower-case and part letters from signs, a word of Latin-1
letters goes to the merges at once, without them, and signs after it are looked up on their own.

Defined cases: a null text is empty, and an empty text is the end token alone; texts of any length are cut in full; equal
documents are packed each on their own; a repeated or null doc_id keeps a row for each of its pieces; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm import shared

WINDOW = 2048
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Of each half of a worker's table of words.
KEPT_WORDS = 100_000
LONGEST_KEPT = 64
WORDS_AT_ONCE = 1_000
SLICE_BYTES = 2 << 20
DOCS_A_TASK, PACKED_AT_ONCE = 500_000, 500_000

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids of whole texts, as little-endian bytes, from a table of words already seen.

    The table has two halves: what is met goes to the young one, and when that is full it becomes the old one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        ids = lambda x: self.tokenizer.encode(x, add_special_tokens=False).ids
        parts = lambda *xs: [i for x in xs for i in ids(x)]
        words = ("Hello", "tokenizers", "x", "Quixotic", "né", "12,5", "(a)")
        self.by_words = all(ids(f"{a}{space}{b}") == parts(a, b) for a in words for b in words for space in (" ", "  ", "\n", " \n "))
        self.model = _letters_model(self.tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words:
            return self._plain(texts)
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words, ends = coded.dictionary, None
        if self.model is not None:
            heads = pc.utf8_rtrim(words, SIGNS)
            short = pc.match_substring_regex(heads, f"^[{LETTERS}]+$")
            ends = pc.if_else(short, pc.utf8_ltrim(words, _ALL_LETTERS), "").dictionary_encode()
            words = pc.if_else(short, pc.utf8_lower(heads), words)
        stems = words.dictionary_encode()
        pool, size = _pool(self._of(_strings(stems.dictionary)))
        units = stems.indices.to_numpy()
        if ends is not None:  # what follows a stem is a unit of its own, perhaps an empty one
            more, more_size = _pool(self._plain(_strings(ends.dictionary)))
            units = np.stack([units, ends.indices.to_numpy() + np.int64(len(size))], axis=1).ravel()
            pool, size = np.concatenate([pool, more]), np.concatenate([size, more_size])
        pool, at = _copied(pool, size, units)
        pool, at = _copied(pool, np.diff(at[:: 1 if ends is None else 2]), coded.indices.to_numpy())
        cuts = at[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [pool[i:j].tobytes() for i, j in itertools.pairwise(cuts)]

    def _of(self, stems: list[str]) -> list[bytes]:
        """Ids of these different stems."""
        found = list(map(self.young.get, stems))
        lost = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in lost:
            x = found[i] = self.old.get(stems[i])
            if x is None:
                new.append(i)
        for i, x in zip(new, self._learn([stems[i] for i in new]), strict=True):
            found[i] = x
        self.young.update((stems[i], found[i]) for i in lost if len(stems[i]) <= LONGEST_KEPT)
        if len(self.young) > KEPT_WORDS:
            self.young, self.old = {"": b""}, self.young
        return found

    def _learn(self, stems: list[str]) -> list[bytes]:
        if self.model is None:
            return self._plain(stems)
        short = [_is_letters(x) is not None for x in stems]
        letters = iter(self._letters([x for x, s in zip(stems, short, strict=True) if s]))
        rest = iter(self._plain([x for x, s in zip(stems, short, strict=True) if not s]))
        return [next(letters) if s else next(rest) for s in short]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of Latin-1 letters: merges alone, many words at once. Each word has one token that ends a word, its last."""
        merge, last = self.model
        out: list[bytes] = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            text = " ".join(some)
            if not text.isascii():
                text = _BYTE_LEVEL[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(merge.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = [0, *(4 * np.flatnonzero(last[ids]) + 4).tolist()]
            if len(cuts) != len(some) + 1:
                raise ValueError("a word does not end with one token that ends words")
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in itertools.pairwise(cuts)]
        return out


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _pool(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and how many each entry has."""
    return np.frombuffer(b"".join(found), dtype="<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4


def _copied(pool: np.ndarray, size: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries that units names, one after another, and where each unit starts, and the end."""
    n = size[units]
    to = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    return pool[np.repeat((np.cumsum(size) - size)[units] - to[:-1], n) + np.arange(to[-1])], to


#: Signs of ASCII that make runs of their own after letters; an apostrophe can begin a unit with letters, so it is none.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_is_letters = re.compile(f"[{LETTERS}]+").fullmatch
_ALL_LETTERS = "".join(c for c in map(chr, range(256)) if _is_letters(c))
#: Byte-level alphabet: the code point that stands for each byte of UTF-8; the space between words stays.
_BYTE_LEVEL = np.arange(256, dtype="<u4")
_BYTE_LEVEL[127:161] = 256 + np.arange(33, 67)
_BYTE_LEVEL[173] = 256 + 67
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _letters_model(tokenizer):
    """For a tokenizer that composes, lower-cases, splits letters from signs and merges bytes up to a mark of a word's end: one of its merges alone, and which ids end words.

    Latin-1 letters are composed already, a run of them is one unit, and signs after it are another, so such words need no more. None for any other tokenizer.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    made = json.loads(tokenizer.to_str())
    normal, units, model = made["normalizer"] or {}, made["pre_tokenizer"] or {}, made["model"]
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in normal.get("normalizers", [])]
    cuts = [{k: v for k, v in x.items() if k != "trim_offsets"} for x in units.get("pretokenizers", [])]
    end = model.get("end_of_word_suffix")
    if not (
        steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        and cuts == [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}]
        and (model["type"], model["dropout"], model["continuing_subword_prefix"], model["ignore_merges"]) == ("BPE", None, None, False)
        and end
        and not any(x["content"].rstrip(SIGNS).isalpha() or not x["content"].strip(SIGNS) for x in made["added_tokens"])
    ):
        return None
    merge = Tokenizer(tokenizer.model)
    merge.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
    last = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
    last[[i for x, i in model["vocab"].items() if x.endswith(end)]] = True
    return merge, last


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `most` bytes of text, one row at least."""
    sizes = np.cumsum(batch.column(column).cast(pa.large_string()).fill_null("").cast(pa.large_binary()).to_pandas().str.len().to_numpy(dtype=np.int64)) if batch.num_rows else np.empty(0, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right"))
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def tokenize_pieces(documents: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) -> one row per piece: full windows from the start, then the remainder. with_ids adds the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("packing", _encoders.clear)
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for whole in batches:
            for b in slices(whole):
                rows = ([], [], [], [], [], [])
                for doc, ids in zip(b.column("doc_id").to_pylist(), enc.encode([t or "" for t in b.column("text").to_pylist()]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        for column, x in zip(rows, (doc, start, len(piece) // 4, zlib.crc32(piece), n, piece), strict=True):
                            column.append(x)
                out = [pa.array(x, pa.int64()) for x in rows[:5]]
                if with_ids:
                    out.append(pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in rows[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in (PIECES + ", ids x" * with_ids).split(", ")])

    return documents.select("doc_id", "text").mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree over capacities counts the windows below each node."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, room: int, sequence: int) -> None:
        if room:
            self.at[room].append(sequence)
            self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Takes out the window with the least room of at least `need`: (room, sequence)."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.at[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; the lengths come in descending order."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    open_, made = OpenWindows(window), 0
    for i, n in enumerate(lengths.tolist()):
        found = open_.tightest(n) if n < window else None
        room, s = found or (window, made)
        made += found is None
        sequence[i], offset[i] = s, window - room
        open_.put(room - n, s)
    return sequence, offset


def partitions_for(documents: DataFrame) -> int:
    """Partitions for packing: the session's, or more where a partition would get over DOCS_A_TASK documents."""
    return max(shared.partitions(documents.sparkSession), -(-documents.count() // DOCS_A_TASK))


def pack(pieces: DataFrame, window: int = WINDOW, partitions: int | None = None) -> DataFrame:
    """Adds sequence_id and offset. Each partition packs on its own; sequence ids hold the partition in their upper bits.

    A partition is packed in lots of up to PACKED_AT_ONCE pieces, so no task holds more. The pieces of a partition are put in
    a total order first, and so are those of a lot, so a task that runs again makes the same plan.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, rows = TaskContext.get().partitionId() << 33, [], 0

        def lot() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, rows
            if rows:
                t = pa.Table.from_batches(held).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).combine_chunks()
                sequence, offset = best_fit(t.column("length").to_numpy(), window)
                yield from t.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset)).to_batches()
                first, held, rows = first + int(sequence.max()) + 1, [], 0

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= PACKED_AT_ONCE:
                yield from lot()
        yield from lot()

    keys = ("doc_id", "start", "ids_crc32")
    n = partitions or shared.partitions(pieces.sparkSession)
    dealt = pieces.select(*(c.split()[0] for c in PIECES.split(", "))).repartition(n, F.xxhash64(*keys)).sortWithinPartitions(F.xxhash64(*keys), *keys)
    return dealt.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def sequences(pieces_with_ids: DataFrame, plan: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids array<int> in order of offset, starts of the pieces."""
    joined = plan.join(pieces_with_ids.select("doc_id", "start", "ids_crc32", "ids"), ["doc_id", "start", "ids_crc32"])
    parts = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"), F.transform("p", lambda x: x["offset"]).alias("starts"))

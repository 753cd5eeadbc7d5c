"""Line deduplication: exact repeats, and lines within a small edit distance, by a segment-partition join.

The threshold goes by length: one edit for each CHARS_PER_EDIT code points of the shorter line, MAX_EDITS at most, so lines under
CHARS_PER_EDIT code points are equal or different. Two lines within t edits share one of t + 1 segments: each line files its own
segments under (length, number of the segment, text), and probes the places where a segment of a line of equal or lesser
length could lie in it, cut down to the multi-match-aware windows. Keys are 64-bit hashes.

A key under which more than HOT_LINES lines are filed is split before anything is joined: around the segment that they share, the
rests of two such lines are within t edits too, so the rests file and probe segments of their own under that key, and so on, DEPTH
times at most. A probe thus meets HOT_LINES lines under a key at most, but for keys that are hot at the last depth.

Lines that meet stay a pair only if the parities of their letters allow so few edits; every such pair is verified on the texts
by a banded bit-parallel edit distance, so a hash that two keys share costs time, never results. Lines go by a 64-bit hash
until their texts are fetched; texts that share one are fetched and verified each, and only two near lines that share theirs with
each other would miss their link.

Classes are connected components of links; of each class, the occurrence with the least (doc_id, line number)
stays. Lines are identified by MD5.

Defined cases: a null text has no lines; blank lines (no character but white space) are no lines here and always stay; equal
occurrences under one (doc_id, line number), from rows that repeat, stay or go together, and different texts
under one doc_id lose their own lines only; rows with a null doc_id take no
part and stay as they are; lines of any length are compared in full; an empty table gives no rows; clean() keeps all columns,
whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm import shared

MAX_EDITS = 2
#: A probing line is longer by that much at most.
MOST_SHORTER = MAX_EDITS
CHARS_PER_EDIT = 20
HOT_LINES = 32
DEPTH = 3
#: So many ids of lines at most go to all tasks to fetch their texts; beyond that the texts are joined by merging.
SENT_IDS = 1_000_000
SLICE_CHARS = 1 << 20
#: Lines of a slice are hashed in runs of so many code points, one line at least, which stay in a core's cache.
HASHED_CHARS = 262144

_PRIME = 0x9E3779B97F4A7C15
_B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


#: What the first code points add to a hash; others are mixed as they come.
with np.errstate(over="ignore"):
    _MIXED = _mix(np.arange(1, 0x3001, dtype=np.uint64))


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _made_powers(2 * HASHED_CHARS)


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_PRIME, pow(_PRIME, -1, 2**64)):
        x = np.full(n + 1, base, dtype=np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, out=x))
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash's base and of its inverse."""
    if n > 2 * HASHED_CHARS:
        return _made_powers(n)
    factors, back = _kept_powers()
    return factors[: n + 1], back[: n + 1]


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance in code points, or most + 1 if it is greater: a band of 2 * most + 1 diagonals held in the bits of one word."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    n, k = len(b), 0
    while k < n and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    while b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    score = gap = len(a) - len(b)
    if not b:
        return score
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, own = (1 << 2 * most + 1) - 1, gap + most
    up, down = full >> most << most, 0  # bit d + most: the vertical step +1 or -1 on diagonal d
    for j, c in enumerate(b):
        shift, found = j - most, places.get(c, 0)
        match = (found >> shift if shift >= 0 else found << -shift) & full
        same = ((((match & up) + up) ^ up) | match | down) & full  # no cost along the diagonal
        right, left = (down | ~(same | up)) & full, same & up
        score += not same >> own & 1
        if score > most:
            return most + 1
        up, down = (left | ~(same >> 1 | right)) & full, same >> 1 & right
    return score


def _segments(length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each of the edits + 1 segments of lines of these lengths: the last ones are longer by one."""
    k = edits + 1
    base, longer = length // k, length % k
    i = np.arange(k)[:, None]
    size = base + (i >= k - longer)
    return np.cumsum(size, axis=0) - size, size


class Hashed:
    """Hashes of any substrings of a batch of lines."""

    def __init__(self, lines: list[str]):
        points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
        factors, self.back = _powers(len(points))
        self.sums = np.zeros(len(points) + 1, dtype=np.uint64)
        terms = _MIXED[np.minimum(points, len(_MIXED) - 1)]
        far = np.flatnonzero(points >= len(_MIXED))
        terms[far] = _mix(points[far].astype(np.uint64) + np.uint64(1))
        np.cumsum(np.multiply(terms, factors[:-1], out=terms), out=self.sums[1:])
        self.points = points
        self.length = np.array([len(x) for x in lines])
        self.start = np.cumsum(self.length) - self.length

    def bags(self) -> np.ndarray:
        """Parity of the number of code points in each of 32 groups: an edit flips two bits at most."""
        return np.bitwise_xor.reduceat(np.uint32(1) << (self.points & np.uint32(31)), self.start).view(np.int32)

    def keys(self, at: np.ndarray, size: np.ndarray, length: np.ndarray, segment: int) -> np.ndarray:
        h = (self.sums[at + size] - self.sums[at]) * self.back[at]
        return _mix(_mix(h) + length.astype(np.uint64) * np.uint64(64) + np.uint64(segment))


def allowed(length, edits: int = MAX_EDITS):
    """Edits within which a line of this length is near a line that is as long or longer."""
    return np.minimum(edits, np.asarray(length) // CHARS_PER_EDIT)


def index_keys(h: Hashed, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Number of the line, key, place, size and limit of each segment of lines that may differ by `limit` edits."""
    out = []
    for t in range(1, int(limit.max(initial=0)) + 1):
        own = np.flatnonzero((limit == t) & (h.length > t))
        at, size = _segments(h.length[own], t)
        out += [(own, h.keys(h.start[own] + at[i], size[i], h.length[own], i), at[i], size[i], np.full(len(own), t)) for i in range(t + 1)]
    return _columns(out)


def probe_keys(h: Hashed, limit_of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """The same of each substring that may equal a segment of a line as long, or shorter by up to its limit; limit_of: limits by the shorter lengths."""
    limits = [limit_of(h.length - less) for less in range(MOST_SHORTER + 1)]
    out = []
    for less, limit in enumerate(limits):
        for t in range(max(1, less), int(limit.max(initial=0)) + 1):
            own = np.flatnonzero((limit == t) & (h.length - less > t))
            length = h.length[own] - less
            at, size = _segments(length, t)
            for i in range(t + 1):
                for shift in range(max(-i, less - (t - i)), min(i, less + (t - i)) + 1):
                    place = at[i] + shift
                    ok = np.flatnonzero((place >= 0) & (place + size[i] <= h.length[own]))
                    out.append((own[ok], h.keys(h.start[own[ok]] + place[ok], size[i][ok], length[ok], i), place[ok], size[i][ok], np.full(len(ok), t)))
    return _columns(out)


def _columns(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    kinds = (np.int64, np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate([np.empty(0, k), *(p[j] for p in parts)]) for j, k in enumerate(kinds))


def _all_keys(h: Hashed, edits: int, probes: bool, limit: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Keys of lines by their lengths, or of rests under a limit of their own."""
    if probes:
        return probe_keys(h, (lambda n: allowed(n, edits)) if limit is None else lambda n: limit)
    return index_keys(h, allowed(h.length, edits) if limit is None else limit)


def _under(parents: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return _mix(keys + _mix(parents))


def rests(lines: list[str], chains: np.ndarray, edits: int, probes: bool) -> tuple[np.ndarray, list[str], np.ndarray]:
    """What is left of each line around the segments that its chain of keys names: number of the line, rest, edits that are allowed.

    chains: (lines, depth). A key can lie at several places of a line, and then each rest counts.
    """
    who, left, limit = np.arange(len(lines)), lines, None
    for depth in range(chains.shape[1]):
        h = Hashed(left)
        row, keys, place, size, t = _all_keys(h, edits, probes, limit)
        if depth:
            keys = _under(chains[who[row], depth - 1], keys)
        hit = np.flatnonzero(keys == chains[who[row], depth])
        left = [left[r][:p] + "\0" + left[r][p + n :] for r, p, n in zip(row[hit].tolist(), place[hit].tolist(), size[hit].tolist(), strict=True)]
        who, limit = who[row[hit]], t[hit]
    return who, left, limit


def _keyed(lines: DataFrame, edits: int, probes: bool) -> DataFrame:
    """(id, line) -> distinct (key, id, bag)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("line_dedup")
        own: dict[str, int] = {}
        chars = 0
        with np.errstate(over="ignore"):

            def out() -> Iterator[pa.RecordBatch]:
                texts, ids = list(own), np.fromiter(own.values(), np.int64, len(own))
                ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
                at = 0
                while at < len(texts):
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HASHED_CHARS, side="right")))
                    h = Hashed(texts[at:to])
                    who, keys, *_ = _all_keys(h, edits, probes)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[at:to][who]), pa.array(h.bags()[who])], names=["key", "id", "bag"])
                    at = to

            for b in batches:
                for i, line in zip(b.column("id").to_numpy().tolist(), b.column("line").to_numpy(zero_copy_only=False).tolist(), strict=True):
                    if line not in own:
                        own[line] = i
                        chars += len(line)
                        if chars >= SLICE_CHARS:
                            yield from out()
                            own, chars = {}, 0
            if own:
                yield from out()

    return lines.mapInArrow(run, "key long, id long, bag int").repartition("key").dropDuplicates(["key", "id", "bag"])


def _split_keys(hot: DataFrame, texts: DataFrame, edits: int, probes: bool) -> DataFrame:
    """(chain, id) of lines under hot keys -> distinct (key, id, bag, chain): the segments of their rests, under the last key of the chain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                if not b.num_rows:
                    continue
                chains = np.array(b.column("chain").to_pylist(), dtype=np.int64).view(np.uint64)
                ids = b.column("id").to_numpy()
                who, left, limit = rests(b.column("line").to_pylist(), chains, edits, probes)
                if not left:
                    continue
                h = Hashed(left)
                row, keys, *_ = _all_keys(h, edits, probes, limit)
                line = who[row]
                depth = chains.shape[1]
                chain = pa.ListArray.from_arrays(pa.array(np.arange(0, depth * len(line) + 1, depth, dtype=np.int32)), pa.array(chains[line].view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(_under(chains[line, -1], keys).view(np.int64)), pa.array(ids[line]), pa.array(h.bags()[row]), chain], names=["key", "id", "bag", "chain"])

    rows = hot.join(texts, "id").select("id", "chain", "line")
    return rows.mapInArrow(run, "key long, id long, bag int, chain array<long>").repartition("key").dropDuplicates(["key", "id", "bag"])


def _met(filed: DataFrame, probes: DataFrame, edits: int, last: bool) -> DataFrame:
    """Lines that meet under a key (ids a and b), and each line that probes a hot key (id a, chain), in one table.

    Of a hot key one row alone joins. Every line probes the keys that it files too, so a hot key's probing lines hold its filed ones.
    """
    by = W.partitionBy("key")
    counted = filed.withColumns({"n": F.count("*").over(by), "least": F.min("id").over(by)})
    hot = F.lit(False) if last else F.col("n") > HOT_LINES
    bags = probes.withColumnsRenamed({"id": "other", "bag": "other_bag", "chain": "other_chain"})
    near = (F.col("id") != F.col("other")) & (F.bit_count(F.col("bag").bitwiseXOR(F.col("other_bag"))) <= 2 * edits)
    longer = F.array_append("chain", F.col("key")) if "chain" in filed.columns else F.array("key")
    both = counted.where(~hot | (F.col("id") == F.col("least"))).join(bags, "key").where(hot | near)
    return both.select(F.when(hot, F.col("other")).otherwise(F.least("id", "other")).alias("a"), F.when(~hot, F.greatest("id", "other")).alias("b"), F.when(hot, longer).alias("chain"))


def occurrences(documents: DataFrame) -> DataFrame:
    """doc_id, line_no, line of each line that is not blank."""
    rows = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.where(F.col("line").rlike(r"[^\s]"))


def _texts(lines: DataFrame, ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, line) of these ids, each text once; known: texts that are there already."""
    wanted = ids.distinct()
    if known is not None:
        wanted = wanted.join(known.select("id"), "id", "left_anti")
    wanted = shared.cut(wanted, "line-ids")
    # a few ids go to every task, and no text moves; many are met by a merge join, whose skewed keys Spark splits
    few = wanted.count() <= SENT_IDS
    found = shared.cut(lines.join(F.broadcast(wanted) if few else wanted.hint("merge"), "id", "left_semi"), "line-found")
    texts = shared.cut(found.distinct(), "line-texts")
    shared.forget(found)
    return texts if known is None else known.unionAll(texts)


def links(documents: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Pairs (a, b), a < b, of MD5 digests of different lines that are near each other."""
    if edits > MOST_SHORTER:
        raise ValueError(f"edits: {MOST_SHORTER} at most")
    spark = documents.sparkSession
    lines = occurrences(documents).where(F.length("line") >= CHARS_PER_EDIT).select(F.xxhash64("line").alias("id"), "line")
    met = shared.cut(_met(*(_keyed(lines, edits, p) for p in (False, True)), edits, DEPTH == 0), "line-met")
    shared.free_shuffles(spark)
    found, texts = [met.where("chain is null").select("a", "b")], None
    for depth in range(1, DEPTH + 1):
        hot = met.where("chain is not null").select(F.col("a").alias("id"), "chain")
        if hot.isEmpty():
            break
        texts = _texts(lines, hot.select("id"), texts)
        met = shared.cut(_met(*(_split_keys(hot, texts, edits, p) for p in (False, True)), edits, depth == DEPTH), "line-met")
        found.append(met.where("chain is null").select("a", "b"))
    pairs = shared.cut(functools.reduce(DataFrame.unionAll, found).distinct(), "line-pairs")
    texts = _texts(lines, pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")), texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                most = int(allowed(min(len(x), len(y)), edits))
                near.append(edit_distance(x, y, most) <= most)
            yield b.filter(pa.array(near, pa.bool_()))

    both = pairs.join(texts.toDF("a", "x"), "a").join(texts.toDF("b", "y"), "b").where("x <> y").select("x", "y")
    near = both.mapInArrow(run, "x string, y string").select(digest("x").alias("p"), digest("y").alias("q"))
    return shared.cut(near.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "line-links")


def digest(line: Column | str) -> Column:
    return F.unhex(F.md5(line))


def judge(documents: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Every line that is not blank: doc_id, line_no, its class's first occurrence (class_doc, class_line), n_links to other texts, kept, digest."""
    near = links(documents, edits)
    labels = shared.components(near).toDF("digest", "label")
    degree = near.select(F.col("a").alias("digest")).unionAll(near.select("b")).groupBy("digest").agg(F.count("*").alias("n_links"))
    near_lines = shared.cut(labels.join(degree, "digest"), "line-labels")
    rows = occurrences(documents).select("doc_id", "line_no", digest("line").alias("digest"))
    first = rows.groupBy("digest").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    labelled = first.join(near_lines, "digest", "left")
    classes = labelled.where("label is not null").groupBy("label").agg(F.min("first").alias("class_first"))
    known = labelled.join(classes, "label", "left").select("digest", F.coalesce("class_first", "first").alias("first"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    out = rows.join(known, "digest")
    kept = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return out.select("doc_id", "line_no", F.col("first.doc_id").alias("class_doc"), F.col("first.line_no").alias("class_line"), "n_links", kept.alias("kept"), "digest")


def clean(documents: DataFrame, judged: DataFrame) -> DataFrame:
    """The documents without the lines that judge() drops; documents that had lines and have none left go."""
    gone = judged.where("not kept").groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "digest")).alias("gone"))
    rows = documents.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = rows.join(gone.withColumnRenamed("doc_id", "id"), "id", "left").select("row.*", "gone")
    names = [*(f"c{k}" for k in range(len(documents.columns))), "gone"]  # by place: a document's columns may have any name
    own_names, at = documents.columns, documents.columns.index("text")
    has_word = re.compile(r"[^ \t-\r]").search

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, stay = b.column(at).to_pylist(), []
            for k, (text, lost) in enumerate(zip(texts, b.column(len(names) - 1).to_pylist(), strict=True)):
                if lost and text is not None:
                    lost = {(x["line_no"], x["digest"]) for x in lost}
                    places = {n for n, _ in lost}
                    texts[k] = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in places or (n, hashlib.md5(x.encode()).digest()) not in lost)
                stay.append(text is None or bool(has_word(texts[k])) or not has_word(text))
            columns = [pa.array(texts, c.type) if k == at else c for k, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=own_names).filter(pa.array(stay, pa.bool_()))

    return joined.toDF(*names).mapInArrow(run, documents.schema)

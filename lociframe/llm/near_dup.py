"""Near-duplicate documents: weighted minwise sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

1. Every document's shingles of five words (all words, if fewer) are hashed to 64 bits with their counts (tf). Each run of
   texts sends each hash bucket one sorted, compressed block; a text that a run holds several times is sent once, with
   its number of copies. A shingle that many documents of a run have is sent as a count, and where those documents are goes
   to buckets salted by run, so a shingle of a third of all rows is no task's burden. A bucket's task counts the
   documents of each hash (df) over the corpus and sends back only hashes that two or more documents have.
2. A shingle weighs tf * idf, idf = 1 + RARE * ln(n / df) / ln(n). Shingles that no other document has are in no
   intersection; they enter a document's total weight alone. A document whose shared weight is under the threshold
   times its total cannot reach the threshold with any other: it leaves here, exactly.
3. The rest get signatures by improved consistent weighted sampling: r, c ~ Gamma(2, 1) and b ~ U(0, 1) for each hash
   function and shingle, drawn by hash from a fixed pool; the unshared weight counts as one private feature. Bands of the signature form buckets.
4. Candidates are verified by exact weighted Jaccard. First each bucket's members are held against one member, its pivot,
   the one whose shingles the most documents have on average, which is the most typical of a group of copies; then, in buckets that still hold
   several classes, against a pivot of the largest class. What is left are pairs of members in different classes. Of them only
   those are tried whose shared weights could reach the threshold; and a bucket of more than SPLIT members is split first. Weighted Jaccard
   is at least J exactly if the L1 distance is at most (1 - J) / (1 + J) of the two weights, so around the pivot, two
   members of which one is not near the pivot have to differ from it in the same features: each member is filed under the features
   in which it differs, as many as a prefix filter needs, and only members that meet there with enough left to share are tried.
5. Classes are the connected components of the links, contracted in tables of the shared folder; nothing is collected.

Joins of members, labels and features are merge joins at every size, so that a plan measured on small tables is the plan of large ones.

Defined cases: a null text, or one without words, is a class of its own; equal texts are one class; rows that repeat a doc_id and
its text are one document, and rows that repeat a doc_id with other texts are documents of their own (result: one row for each,
told apart by text_hash); rows with a null doc_id take no part, and keep_one() keeps them; a document under five words has one shingle; empty tables give
no rows; keep_one() keeps all columns.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm import shared
from lociframe.llm.packing import slices

WORDS = 5
THRESHOLD = 0.8
RARE = 0.2
BANDS, ROWS = 40, 6
PIVOT_ROUNDS = 1
#: Open buckets with more members are split by what their members differ in from the pivot.
SPLIT = 128
BUCKET_SHINGLES = 1_000_000
#: Documents up to this number are sent to the tasks that read features; more meet them by shuffle.
SENT_IDS = 500_000
RUN_BYTES = 4 << 20
CHUNK = 1 << 20
#: A shingle is hot in a run if that many of its documents, and this share of them, have it.
HOT_DOCS, HOT_SHARE = 64, 0.05
ENTRIES, DIRECTORY, PENDING, HOT = 0, 1, 2, 3

_PRIME = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(11).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
_B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers as byte planes under Zstandard."""
    planes = [np.ascontiguousarray(np.asarray(a).astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes() for a in arrays]
    return struct.pack(f"<I{len(arrays)}I", len(arrays), *map(len, arrays)) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    n = struct.unpack_from("<I", blob)[0]
    sizes = struct.unpack_from(f"<{n}I", blob, 4)
    data, out, at = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4 + 4 * n :]), np.uint8), [], 0
    for size in sizes:
        out.append(np.ascontiguousarray(data[at : at + 8 * size].reshape(8, -1).T).view(np.uint64).ravel())
        at += 8 * size
    return out


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of each word, in chunks that end between words."""
    at, starts, hashes = 0, [], []
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data) and not _SPACE[data[to]]:
            more = np.flatnonzero(_SPACE[data[to : to + CHUNK]])
            to = to + int(more[0]) if len(more) else min(len(data), to + CHUNK)
        part = data[at:to]
        if len(_powers[0]) <= len(part):
            for k, base in enumerate((_PRIME, pow(_PRIME, -1, 2**64))):
                factors = np.full(len(part) + 1, base, dtype=np.uint64)
                factors[0] = 1
                _powers[k] = np.cumprod(factors, dtype=np.uint64)
        solid = np.concatenate([[False], ~_SPACE[part], [False]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        s, e = edges[::2], edges[1::2]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[part] * _powers[0][: len(part)], out=sums[1:])
        starts.append(s + at)
        hashes.append(_mix((sums[e] - sums[s]) * _powers[1][s] + (e - s).astype(np.uint64) * _C))
        at = to
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.empty(0, np.int64), np.empty(0, np.uint64))


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, and hash, of each shingle of each text, and the number of shingles of each text."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, h = word_hashes(np.frombuffer(b"\n".join(texts), np.uint8))
    doc = np.searchsorted(ends, starts, side="right")
    n = np.bincount(doc, minlength=len(texts)) if len(texts) else np.empty(0, np.int64)
    first = np.cumsum(n) - n
    whole = np.zeros(max(0, len(h) - words + 1), dtype=np.uint64)
    for j in range(words if len(whole) else 0):
        whole = whole * np.uint64(_PRIME) + h[j : j + len(whole)]
    fits = np.flatnonzero(doc[: len(whole)] == doc[words - 1 :]) if len(whole) else np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < words))
    single = np.zeros(len(short), dtype=np.uint64)
    for j in range(words - 1):
        more = n[short] > j
        single[more] = single[more] * np.uint64(_PRIME) + h[first[short[more]] + j]
    return np.concatenate([doc[fits], short]), np.concatenate([_mix(whole[fits]), _mix(single + n[short].astype(np.uint64) * _C)]), np.where(n >= words, n - words + 1, np.minimum(n, 1))


def _spread(x: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash."""
    return ((x >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _runs(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else ((),) * 4, kinds, strict=True)], names=["part", "kind", "h", "block"])


BLOCKS = "part int, kind int, h long, block binary"


def send_run(ids: list[int], texts: list[bytes], n_parts: int, seed: int) -> list[tuple]:
    """What one run of documents sends to the hash buckets."""
    groups: dict[bytes, list[int]] = {}
    for i, t in zip(ids, texts, strict=True):
        groups.setdefault(t, []).append(i)
    copies = [sorted(set(x)) for x in groups.values()]
    reps = np.array([x[0] for x in copies], dtype=np.int64)
    doc, h, n = shingles(list(groups))
    order = np.argsort(h, kind="stable")
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.empty(0, np.int64)
    tf = np.diff(new, append=len(h))
    doc, h = doc[new], h[new]
    number = np.array([len(x) for x in copies], dtype=np.int64)
    out = []
    # where each document's features will meet: copies, then number of shingles
    # a text without words is nobody's copy
    flat = [(i, int(k), reps[j] if k else i) for j, (x, k) in enumerate(zip(copies, n.tolist(), strict=True)) for i in x]
    who, shingle_count, rep = (np.array(x, dtype=np.int64) for x in zip(*flat, strict=True))
    at = home(who, n_parts)
    for part in np.unique(at).tolist():
        m = at == part
        out.append((part, DIRECTORY, 0, pack(who[m], shingle_count[m], rep[m])))
    starts = _runs(h)
    size = np.diff(starts, append=len(h))
    hot = size >= max(HOT_DOCS, HOT_SHARE * len(copies))
    cold = np.repeat(~hot, size)
    for s, k in zip(starts[hot].tolist(), size[hot].tolist(), strict=True):
        d = doc[s : s + k]
        part = int(_spread(_mix(h[s : s + 1] + np.uint64(seed)), n_parts)[0])
        out.append((part, PENDING, int(h[s].astype(np.int64)), pack(reps[d], tf[s : s + k])))
    marks_h, marks_n = h[starts[hot]], np.array([number[doc[s : s + k]].sum() for s, k in zip(starts[hot], size[hot], strict=True)], dtype=np.int64)
    h, doc, tf = h[cold], doc[cold], tf[cold]
    of_entry, of_mark = _spread(h, n_parts), _spread(marks_h, n_parts)
    present = np.union1d(of_entry, of_mark)
    bounds = [np.searchsorted(x, present, side=side).tolist() for x in (of_entry, of_mark) for side in ("left", "right")]
    for part, a, b, c, d in zip(present.tolist(), *bounds, strict=True):
        local, at = np.unique(doc[a:b], return_inverse=True)
        out.append((part, ENTRIES, 0, pack(np.diff(h[a:b], prepend=np.uint64(0)), at, tf[a:b], reps[local], number[local], marks_h[c:d], marks_n[c:d])))
    return out


def home(doc_ids: np.ndarray, n_parts: int) -> np.ndarray:
    return _spread(_mix(doc_ids.astype(np.uint64) + np.uint64(1)), n_parts)


def _send(n_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("near_dup")
        with np.errstate(over="ignore"):
            for whole in batches:
                for b in slices(whole, most=RUN_BYTES):
                    rows = [(i, (t or "").encode()) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) if i is not None]
                    if rows:
                        ids, texts = zip(*rows, strict=True)
                        yield _rows(send_run(list(ids), list(texts), n_parts, hash(ids[0]) & 0xFFFFFFFF))

    return run


def _by_home(doc: np.ndarray, h: np.ndarray, tf: np.ndarray, df: np.ndarray, n_parts: int) -> list[tuple]:
    at = home(doc, n_parts)
    order = np.argsort(at, kind="stable")
    starts = _runs(at[order])
    ends = np.append(starts, len(order))[1:]
    return [(int(at[order[a]]), ENTRIES, 0, pack(*(x[order[a:b]] for x in (doc, h, tf, df)))) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _count(n_parts: int):
    """A hash bucket: df of each hash; what is shared goes on to the documents' homes."""

    def run(t: pa.Table) -> pa.Table:
        shared.claim("near_dup")
        with np.errstate(over="ignore"):
            out, parts = [], []
            for part, kind, h, block in zip(*(t.column(c).to_pylist() for c in ("part", "kind", "h", "block")), strict=True):
                if kind == ENTRIES:
                    parts.append(unpack(block))
                else:
                    out.append((part, kind, h, block))
            if parts:
                h = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
                doc = np.concatenate([p[3][p[1].astype(np.int64)] for p in parts]).astype(np.int64)
                number = np.concatenate([p[4][p[1].astype(np.int64)] for p in parts]).astype(np.int64)
                tf = np.concatenate([p[2] for p in parts]).astype(np.int64)
                mark_h, mark_n = (np.concatenate([p[k] for p in parts]) for k in (5, 6))
                order = np.argsort(h, kind="stable")
                starts = _runs(h[order])
                size = np.diff(starts, append=len(h))
                marked = np.isin(h[order[starts]], mark_h) if len(mark_h) else np.zeros(len(starts), dtype=bool)
                keep = order[np.repeat((size > 1) | (number[order[starts]] > 1) | marked, size)]
                keep = keep[np.lexsort((-tf[keep], doc[keep], h[keep]))]
                first = np.concatenate([[True], (h[keep][1:] != h[keep][:-1]) | (doc[keep][1:] != doc[keep][:-1])]) if len(keep) else np.empty(0, bool)
                keep = keep[first]
                h, doc, tf, number = h[keep], doc[keep], tf[keep], number[keep]
                starts = _runs(h)
                size = np.diff(starts, append=len(h))
                df = np.add.reduceat(number, starts) if len(starts) else np.empty(0, np.int64)
                if len(mark_h):
                    hot, at = np.unique(mark_h, return_inverse=True)
                    total = np.bincount(at, mark_n.astype(np.int64)).astype(np.int64)
                    where = np.searchsorted(hot, h[starts])
                    where = np.minimum(where, len(hot) - 1)
                    same = hot[where] == h[starts]
                    df[same] += total[where[same]]
                    total[where[same]] = df[same]
                    out += [(0, HOT, int(x), pack(np.array([n]))) for x, n in zip(hot.astype(np.int64).tolist(), total.tolist(), strict=True)]
                many = np.repeat(df > 1, size)
                out += _by_home(doc[many], h[many], tf[many], np.repeat(df, size)[many], n_parts)
            return pa.Table.from_batches([_rows(out)])

    return run


def _resolve(n_parts: int):
    """Pending documents of a hot hash, joined to its df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                got = [[], [], [], []]
                for h, block, df in zip(*(b.column(c).to_pylist() for c in ("h", "block", "df")), strict=True):
                    doc, tf = unpack(block)
                    for column, x in zip(got, (doc.astype(np.int64), np.full(len(doc), np.int64(h).astype(np.uint64)), tf, np.full(len(doc), unpack(df)[0][0])), strict=True):
                        column.append(x)
                if got[0]:
                    yield _rows(_by_home(*(np.concatenate(x) for x in got), n_parts))

    return run


def pool(size: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(23)
    return rng.gamma(2, 1, size), np.log(rng.gamma(2, 1, size)), rng.uniform(0, 1, size)


def signatures(h: np.ndarray, w: np.ndarray, starts: np.ndarray, n_hashes: int) -> np.ndarray:
    """Improved consistent weighted sampling: (documents, n_hashes). The features of a document lie side by side in order of hash."""
    r_, lnc_, b_ = pool()
    out = np.empty((len(starts), n_hashes), dtype=np.uint64)
    lnw, doc = np.log(w), np.repeat(np.arange(len(starts)), np.diff(starts, append=len(h)))
    for k in range(n_hashes):
        at = (_mix(h + np.uint64((k + 1) * _PRIME & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(48)).astype(np.int64)
        r, b = r_[at], b_[at]
        t = np.floor(lnw / r + b)
        a = lnc_[at] - r * (t - b) - r
        least = np.minimum.reduceat(a, starts)
        win = np.flatnonzero(a == least[doc])
        win = win[_runs(doc[win])]
        out[:, k] = _mix(h[win] + _mix(t[win].astype(np.int64).astype(np.uint64)))
    return out


def _whole_signatures(h: np.ndarray, w: np.ndarray, at: np.ndarray, rest: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Signatures over shared shingles and one private feature that has the weight of all others, so collisions go by the whole similarity."""
    own = np.unique(at)
    own = own[rest[own] > 0]
    h = np.concatenate([h, _mix(ids[own].astype(np.uint64) + np.uint64(_PRIME))])
    w, at = np.concatenate([w, rest[own]]), np.concatenate([at, own])
    order = np.lexsort((h, at))
    return signatures(h[order], w[order], _runs(at[order]), BANDS * ROWS)


STATE = "doc_id long, rep long, total double, inside double, typical double, hs binary, ws binary, digest long, keys array<long>"


def _gather(n_docs: int, threshold: float):
    """The documents of one home: weights, exact pruning, signatures."""
    top = np.log(max(2, n_docs))

    def run(t: pa.Table) -> pa.Table:
        shared.claim("near_dup")
        with np.errstate(over="ignore"):
            lists, feats = [], []
            for kind, block in zip(t.column("kind").to_pylist(), t.column("block").to_pylist(), strict=True):
                (lists if kind == DIRECTORY else feats).append(unpack(block))
            who, n, rep = (np.concatenate([x[k] for x in lists]).astype(np.int64) for k in range(3)) if lists else (np.empty(0, np.int64),) * 3
            ids, at = np.unique(who, return_inverse=True)
            total_n, least = np.zeros(len(ids), dtype=np.int64), np.full(len(ids), np.iinfo(np.int64).max)
            np.maximum.at(total_n, at, n)
            np.minimum.at(least, at, rep)
            rows = [ids, least, *np.zeros((3, len(ids)))]
            hs, ws, digest, keys = ([None] * len(ids) for _ in range(4))
            if feats:
                doc, h, tf, df = (np.concatenate([x[k] for x in feats]) for k in range(4))
                at = np.searchsorted(ids, doc.astype(np.int64))
                ok = least[at] == ids[at]
                doc, h, tf, df, at = doc[ok], h[ok], tf[ok].astype(np.int64), df[ok].astype(float), at[ok]
                order = np.lexsort((-tf, h, at))
                h, tf, df, at = h[order], tf[order], df[order], at[order]
                first = np.concatenate([[True], (h[1:] != h[:-1]) | (at[1:] != at[:-1])]) if len(h) else np.empty(0, bool)
                h, tf, df, at = h[first], tf[first], df[first], at[first]
                w = (tf * (1 + RARE * np.log(np.maximum(1, n_docs / df)) / top)).astype(np.float32).astype(float)
                inside, own_tf = np.bincount(at, w, len(ids)), np.bincount(at, tf, len(ids))
                rest = np.maximum(0, total_n - own_tf) * (1 + RARE)
                rows[2:] = inside + rest, inside, np.bincount(at, tf * np.log(df), len(ids)) / np.maximum(1, total_n)
                chosen = (inside > 0) & (inside >= (threshold - 1e-9) * rows[2])
                m = chosen[at]
                h, w, at = h[m], w[m], at[m]
                if len(h):
                    starts = _runs(at)
                    ends = np.append(starts[1:], len(h))
                    sig = _whole_signatures(h, w, at, rest, ids)
                    band = np.zeros((len(starts), BANDS), dtype=np.uint64)
                    for k in range(ROWS):
                        band = _mix(band * np.uint64(_PRIME) + sig[:, k * BANDS : (k + 1) * BANDS])
                    band = _mix(band + np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
                    for i, (d, a, b) in enumerate(zip(at[starts].tolist(), starts.tolist(), ends.tolist(), strict=True)):
                        hs[d], ws[d], keys[d] = h[a:b].tobytes(), w[a:b].astype(np.float32).tobytes(), band[i]
                        if rest[d] == 0:
                            weights = w[a:b].astype(np.float32).view(np.uint32).astype(np.uint64)
                            digest[d] = int(np.bitwise_xor.reduce(_mix(h[a:b] + _mix(weights))).astype(np.int64))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            return pa.Table.from_arrays([pa.array(x, k) for x, k in zip((*rows, hs, ws, digest, keys), kinds, strict=True)], names=[c.split()[0] for c in STATE.split(", ")])

    return run


def jaccard(h1: np.ndarray, w1: np.ndarray, t1: float, h2: np.ndarray, w2: np.ndarray, t2: float) -> float:
    """Weighted Jaccard of two documents from their shared features and total weights."""
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    common = float(np.minimum(w1[i], w2[j]).sum(dtype=float))
    return common / (t1 + t2 - common)


def _named_in(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """The documents of pairs: while they are few, the others' features are left out before any shuffle."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    return state.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= SENT_IDS else state


def verify(pairs: DataFrame, state: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b), a written table, of at least the threshold."""
    state = _named_in(pairs, state)
    side = lambda x: state.select(F.col("doc_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("total", "hs", "ws")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for r in zip(*(b.column(f"{c}_{x}") for x in "ab" for c in ("hs", "ws", "total")), strict=True):
                v = [x.as_py() for x in r]
                sets = [np.frombuffer(v[0], np.uint64), np.frombuffer(v[1], np.float32), v[2], np.frombuffer(v[3], np.uint64), np.frombuffer(v[4], np.float32), v[5]]
                keep.append(jaccard(*sets) >= threshold - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # merge joins at every size: features are shuffled alike whether pairs are few or many
    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").mapInArrow(run, "a long, b long")


def _cross(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Distinct pairs of members with their bucket's pivot in another class."""
    joined = members.join(pivots.hint("merge"), "key").where((F.col("label") != F.col("pivot_label")) & (F.col("doc_id") != F.col("pivot")))
    return joined.select(F.least("doc_id", "pivot").alias("a"), F.greatest("doc_id", "pivot").alias("b")).distinct()


def _can_reach(threshold: float) -> Column:
    """Whether the shared weight of both sides allows the threshold: what they have in common is part of either's."""
    both = F.col("total") + F.col("other_total")
    return F.least("inside", "other_inside") >= (threshold / (1 + threshold) - 1e-9) * both


def _differences(threshold: float):
    """Members of a bucket filed under the features in which they differ from its pivot.

    With a = (1 - J) / (1 + J) and slack s = distance to the pivot - a * weight, two members reach J exactly if the differences that
    they share weigh (s + s') / 2 at least. A member near the pivot has s <= a * pivot's weight, and no slack is under
    -a * pivot's weight; as one of the two is not near, each has a least weight to share, and a feature is
    filed while what follows in order, itself included, still weighs that much.
    """
    reach = (1 - threshold) / (1 + threshold)
    lacks = np.uint64(0x5851F42D4C957F2D)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for r in batch.to_pylist():
                (h, w), (ph, pw) = ((np.frombuffer(r[f"{x}hs"], np.uint64), np.frombuffer(r[f"{x}ws"], np.float32).astype(float)) for x in ("", "pivot_"))
                _, i, j = np.intersect1d(h, ph, assume_unique=True, return_indices=True)
                slack = r["total"] + r["pivot_total"] - 2 * np.minimum(w[i], pw[j]).sum() - reach * r["total"]
                far = reach * r["pivot_total"]
                least = (slack - far if slack > far else slack + far) / 2 - 1e-6 * r["total"]
                more, less = w.copy(), pw.copy()
                more[i] -= pw[j]
                less[j] -= w[i]
                # the pivot's unshared weight is lacking in all others, so it comes last
                whole = max(0.0, r["pivot_total"] - pw.sum())
                feature = np.concatenate([np.sort(_mix(h[more > 1e-9])), np.sort(_mix(ph[less > 1e-9] ^ lacks)), [lacks]])
                weight = np.concatenate([more[more > 1e-9][np.argsort(_mix(h[more > 1e-9]))], less[less > 1e-9][np.argsort(_mix(ph[less > 1e-9] ^ lacks))], [whole]])
                rest = np.cumsum(weight[::-1])[::-1]
                kept = np.flatnonzero((rest >= least) & (weight > 0))
                keys = _mix(feature[kept] + _mix(np.array([r["key"]], dtype=np.int64).view(np.uint64)))
                for column, x in zip(out, (keys.view(np.int64), np.full(len(kept), r["doc_id"]), np.full(len(kept), r["label"]), np.full(len(kept), slack), rest[kept]), strict=True):
                    column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["key", "doc_id", "label", "slack", "rest"])

    return run


def _other(rows: DataFrame) -> DataFrame:
    return rows.select("key", *(F.col(c).alias("other" if c == "doc_id" else f"other_{c}") for c in rows.columns if c != "key"))


def _across(members: DataFrame, pivots: DataFrame, state: DataFrame, threshold: float) -> DataFrame:
    """Pairs of members of a bucket in different classes that may reach the threshold. pivots: (key, pivot), with which all members of a bucket were tried."""
    sized = members.join(state.select("doc_id", "total", "inside", "keys").hint("merge"), "doc_id")
    # a member that could not even reach the threshold with the lightest one has no partner here
    lightest = sized.groupBy("key").agg(F.min("total").alias("other_total"))
    able = shared.cut(sized.join(lightest.hint("merge"), "key").withColumn("other_inside", F.col("inside")).where(_can_reach(threshold)).drop("other_total", "other_inside"), "able")
    size = able.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key", (F.col("n") > SPLIT).alias("large"))
    size = shared.cut(size, "sizes")
    apart = (F.col("doc_id") < F.col("other")) & (F.col("label") != F.col("other_label"))
    small = able.join(size.where("not large").hint("merge"), "key").select("key", "band", "doc_id", "label", "total", "inside", "keys")
    # each pair from the first band alone that holds both
    earlier = F.arrays_zip(F.slice("keys", F.lit(1), F.col("band")).alias("x"), F.slice("other_keys", F.lit(1), F.col("band")).alias("y"))
    pairs = small.join(_other(small), "key").where(apart & _can_reach(threshold) & ~F.exists(earlier, lambda z: z["x"] == z["y"])).select("doc_id", "other")
    if size.where("large").isEmpty():
        out = pairs
    else:
        # large buckets around one pivot, as the bands of one group of copies give, are one: each member is filed once
        large = able.join(size.where("large").hint("merge"), "key").join(pivots.hint("merge"), "key").where("doc_id <> pivot").select(F.col("pivot").alias("key"), "doc_id", "label", "total", "pivot").distinct()
        large = shared.cut(large, "large")
        state = _named_in(large.select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")), state)
        features = state.select("doc_id", "hs", "ws")
        large = large.join(features.hint("merge"), "doc_id").join(state.select(F.col("doc_id").alias("pivot"), *(F.col(c).alias(f"pivot_{c}") for c in ("total", "hs", "ws"))).hint("merge"), "pivot")
        filed = shared.cut(large.drop("pivot").mapInArrow(_differences(threshold), "key long, doc_id long, label long, slack double, rest double"), "filed")
        met = filed.join(_other(filed), "key").where(apart & (F.least("rest", "other_rest") >= (F.col("slack") + F.col("other_slack")) / 2 - 1e-6 * F.greatest("rest", "other_rest")))
        out = pairs.unionAll(met.select("doc_id", "other"))
    return out.select(F.col("doc_id").alias("a"), F.col("other").alias("b")).distinct()


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def classes(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text) -> one row per document: doc_id, class_id, the least doc_id of its class.

    Where some doc_id has several texts there are two more columns: text_hash, null for all others, and class_key, as several
    classes may then have the same least doc_id. Such documents go by numbers of their own in between.
    """
    documents = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    by_id = documents.groupBy("doc_id").agg(F.min(text_hash()).alias("x"), F.max(text_hash()).alias("y"))
    several = shared.cut(by_id.where("x <> y").select("doc_id"), "several-texts")
    if several.isEmpty():
        return _classes(documents, threshold)
    beyond = documents.agg(F.max("doc_id").alias("m")).first()["m"] + 1
    texts = documents.withColumn("text_hash", text_hash())
    own = texts.join(several, "doc_id").select("doc_id", "text_hash").distinct().withColumn("number", F.monotonically_increasing_id() + beyond)
    own = shared.cut(own, "own-numbers")
    numbered = texts.join(own, ["doc_id", "text_hash"], "left").select(F.coalesce("number", "doc_id").alias("doc_id"), "text")
    found = _classes(numbered, threshold).withColumnRenamed("doc_id", "number").join(own, "number", "left")
    found = shared.cut(found.select(F.coalesce("doc_id", "number").alias("doc_id"), "text_hash", "class_id"), "found")
    least = found.groupBy("class_id").agg(F.min("doc_id").alias("least"))
    return found.join(least, "class_id").select("doc_id", F.col("least").alias("class_id"), "text_hash", F.col("class_id").alias("class_key"))


def _classes(documents: DataFrame, threshold: float) -> DataFrame:
    """The same where each doc_id has one text."""
    spark = documents.sparkSession
    size = documents.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n_parts = max(shared.partitions(spark), -(-(size["b"] or 0) // 6 // BUCKET_SHINGLES))
    sent = documents.mapInArrow(_send(n_parts), BLOCKS)
    counted = shared.cut(sent.groupBy("part").applyInArrow(_count(n_parts), BLOCKS), "counted")
    del sent
    shared.free_shuffles(spark)
    hot = counted.where(F.col("kind") == HOT).select("h", F.col("block").alias("df"))
    pending = counted.where(F.col("kind") == PENDING).select("h", "block").join(hot, "h").mapInArrow(_resolve(n_parts), BLOCKS)
    homes = counted.where(F.col("kind").isin(ENTRIES, DIRECTORY)).unionAll(pending)
    state = shared.cut(homes.groupBy("part").applyInArrow(_gather(size["n"], threshold), STATE), "state")
    del homes, pending, hot
    shared.forget(counted)
    shared.free_shuffles(spark)

    equal = state.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    full = state.where("digest is not null").select("doc_id", "digest")
    alike = shared.cut(full.join(full.groupBy("digest").agg(F.min("doc_id").alias("b")), "digest").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b"), "alike")
    members = state.where("keys is not null").join(alike.select(F.col("a").alias("doc_id")).hint("merge"), "doc_id", "left_anti")
    members = members.select("doc_id", "typical", F.posexplode("keys").alias("band", "key"))
    # buckets of two members or more
    by_key = members.groupBy("key").agg(F.max(F.struct("typical", -F.col("doc_id"))).alias("top"), F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    shared_keys = by_key.where("least <> last").select("key", (-F.col("top.col2")).alias("pivot"))
    members = shared.cut(members.join(shared_keys.hint("merge"), "key").select("key", "band", "doc_id", "pivot"), "members")
    first = members.where("doc_id <> pivot").select(F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")).distinct()
    tried = shared.cut(first, "tried")
    links = shared.cut(verify(tried, state, threshold), "links")
    shared.free_shuffles(spark)

    for turn in range(PIVOT_ROUNDS + 1):
        labels = shared.components(links)
        named = members.select("key", "band", "doc_id").join(labels.toDF("doc_id", "label").hint("merge"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
        open_keys = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
        named = shared.cut(named.join(open_keys.hint("merge"), "key"), "open")
        if turn == PIVOT_ROUNDS:
            pairs = _across(named, members.where("doc_id = pivot").select("key", "pivot"), state, threshold)
        else:
            by_class = named.groupBy("key", "label").agg(F.count("*").alias("n"), F.min_by("doc_id", F.xxhash64("doc_id", "key", F.lit(turn))).alias("pivot"))
            largest = by_class.groupBy("key").agg(F.max_by(F.struct("pivot", "label"), F.struct("n", "label")).alias("p"))
            pairs = _cross(named, largest.select("key", F.col("p.pivot").alias("pivot"), F.col("p.label").alias("pivot_label")))
        pairs = shared.cut(pairs.join(tried.hint("merge"), ["a", "b"], "left_anti"), "pairs")
        # what was written before is read along with the new part, not written again
        links = links.unionAll(shared.cut(verify(pairs, state, threshold), "links"))
        tried = tried.unionAll(pairs)
        shared.forget(named)
        shared.free_shuffles(spark)

    labels = shared.components(links.unionAll(alike).unionAll(equal)).toDF("doc_id", "label")
    return state.select("doc_id").join(labels.hint("merge"), "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("class_id"))


def keep_one(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Of each class in found the document with the least doc_id, and the least text_hash under it; rows that repeat doc_id and text are one."""
    if "text_hash" not in found.columns:
        found = found.withColumns({"text_hash": F.lit(None).cast("long"), "class_key": F.col("class_id")})
    first = found.groupBy("class_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    other = (F.col("doc_id") != F.col("first.doc_id")) | ~F.col("text_hash").eqNullSafe(F.col("first.text_hash"))
    gone = found.join(first, "class_key").where(other).select(F.col("doc_id").alias("gone_id"), "text_hash")
    gone = shared.cut(gone, "gone")
    # ids of bounded number go to the documents; more of them are met by shuffle
    gone = F.broadcast(gone) if gone.count() <= SENT_IDS else gone
    hashed = documents.withColumn("near_dup_hash", text_hash())
    same = (F.col("doc_id") == F.col("gone_id")) & (F.col("text_hash").isNull() | (F.col("text_hash") == F.col("near_dup_hash")))
    kept = hashed.join(gone, same, "left_anti")
    repeats = documents.where("doc_id is not null").groupBy("doc_id", text_hash().alias("near_dup_hash")).count().where("count > 1")
    if repeats.isEmpty():
        return kept.select(*documents.columns)
    once = kept.where("doc_id is not null").dropDuplicates(["doc_id", "near_dup_hash"])
    return kept.where("doc_id is null").unionAll(once).select(*documents.columns)

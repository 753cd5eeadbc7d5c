"""Exact Jaccard join on word shingles by prefixes of token combinations.

1. Each text becomes a set of hashed shingles. Equal sets are one node from here on, so copies cost no pairs.
2. A first pass needs no frequencies: with tokens in order of hash, two sets that reach the threshold share at least l tokens of
   their first n - o + l, where o is the least overlap of a set of n. Each set sends that extended prefix (a fifth of
   its tokens) once; tokens that no other set sends are counted for each set, and a set with too few others leaves. Only
   counts are shuffled, so a token of a third of all rows is one row of each task.
3. The sets that are left are ordered by true frequency among them. Tokens fall into classes: rare tokens form one
   class with single tokens as signatures; frequent tokens fall into classes by hash, with pairs of tokens of a class as
   signatures. A prefix ends where, whichever n - o tokens the other set may lack, one class still has a whole
   signature: sum over classes of (tokens - signature size + 1) reaches n - o + 1. Both prefixes start at the rarest token, so the
   shorter one's signature is in the other too. The number of frequent classes grows with the sets' size, which
   keeps combinations linear in it; a set signs for the size level of each partner that is larger.
4. Sets that share a signature and fit in size are verified by exact intersection. A signature's sets are first held against one of them,
   the most typical. What then is in one component needs no further link; other pairs of small buckets are
   tried, and in large buckets those that differ from the typical set in the same tokens, enough to reach the threshold (as near-duplicates are).
5. Components are contracted in tables; nothing but counts comes to the driver.

Defined cases: a null text or one without words is an empty set, linked with nothing; one or two words are one shingle; equal sets
of one token or more are linked; rows that repeat a doc_id are sets of their own; a null doc_id links as any other, and is the
component_id only where its component has no other id; empty tables give no rows; other columns are ignored. Shingles are 64-bit hashes, sets 128-bit ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm import near_dup, shared
from lociframe.llm.packing import slices

WORDS = 3
#: Similar: SIMILAR[0] * intersection >= SIMILAR[1] * union.
SIMILAR = (100, 90)
#: A token that more of the sets have is frequent: it signs in pairs.
FREQUENT = 32
#: Prefix tokens that a frequent class is meant to have.
CLASS_TOKENS = 4
#: Buckets with more sets are split by what the sets differ in from the typical one.
SPLIT = 64
RUN_BYTES = 2 << 20
#: Bytes of tokens that are verified at once.
VERIFY_BYTES = 16 << 20
#: Survivors up to this number are sent to all tasks that read documents; more are joined by shuffle.
SENT_ROWS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def least_overlap(n, similar: tuple[int, int] = SIMILAR):
    """Tokens that a set of n shares at least with any similar set."""
    return -(-n * similar[1] // similar[0])


def has_partners(n, similar: tuple[int, int] = SIMILAR):
    """Whether a set of n may be similar to a different one."""
    return (n > least_overlap(n, similar)) | (n * similar[0] // similar[1] > n)


def first_prefix(n, similar: tuple[int, int] = SIMILAR):
    """Tokens of the extended prefix in order of hash."""
    return 2 * (n - least_overlap(n, similar)) + 1


def first_need(n, similar: tuple[int, int] = SIMILAR):
    """Tokens of that prefix which a similar set's prefix has at least: what the smallest partner's prefix is extended by."""
    small = least_overlap(n, similar)
    return small - least_overlap(small, similar) + 1


def token_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct tokens of each text, and all texts' tokens, each text's in ascending order."""
    lowered = [_LOWER[np.frombuffer(t, np.uint8)].tobytes() for t in texts]
    doc, h, _ = near_dup.shingles(lowered, words)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.empty(0, bool)
    return np.bincount(doc[new], minlength=len(texts)).astype(np.int64), h[new]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values.view(np.int64)))


def _heads(sizes: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Marks the first most[i] of each run of sizes[i]."""
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return place < np.repeat(most, sizes)


def _digests(sizes: np.ndarray, tokens: np.ndarray) -> list[str | None]:
    ends = np.cumsum(sizes)
    return [hashlib.md5(tokens[e - n : e].tobytes()).hexdigest() if n else None for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in b.column("text").to_pylist()]


def _sketch(words: int, similar: tuple[int, int]):
    """doc_id, text, th -> doc_id, th, n, key, mark, prefix: the set's size, its digest, half of that as a number, and its extended prefix by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("ngram_join")
        with np.errstate(over="ignore"):
            for whole in batches:
                for b in slices(whole, most=RUN_BYTES):
                    n, tokens = token_sets(_texts(b), words)
                    sent = np.minimum(n, np.where(has_partners(n, similar), first_prefix(n, similar), 0))
                    keys = _digests(n, tokens)
                    marks = np.array([int(k[:16], 16) if k else 0 for k in keys], dtype=np.uint64).view(np.int64)
                    columns = [b.column("doc_id"), b.column("th"), pa.array(n), pa.array(keys, pa.string()), pa.array(marks), _lists(tokens[_heads(n, sent)], sent)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "n", "key", "mark", "prefix"])

    return run


def _sets(words: int):
    """key, text -> key, n, tokens, for rows whose set has that key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared.claim("ngram_join")
        with np.errstate(over="ignore"):
            for whole in batches:
                for b in slices(whole, most=RUN_BYTES):
                    n, tokens = token_sets(_texts(b), words)
                    wanted = np.array([x == y for x, y in zip(_digests(n, tokens), b.column("key").to_pylist(), strict=True)], dtype=bool)
                    yield pa.RecordBatch.from_arrays([b.column("key").filter(pa.array(wanted)), pa.array(n[wanted]), _lists(tokens[np.repeat(wanted, n)], n[wanted])], names=["key", "n", "tokens"])

    return run


def level_of(n: int) -> int:
    """Size level: sets of one level are within a factor of two."""
    return int(n).bit_length()


def classes_of(level: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Frequent classes for pairs of that level."""
    most = (1 << level) - 1
    return max(1, int(most - least_overlap(most, similar)) // CLASS_TOKENS)


def signatures(n: int, df: np.ndarray, h: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """Signatures of a set of n tokens, of which those that other sets have too are given, by ascending (df, h)."""
    errors = n - int(least_overlap(n, similar))
    alone = n - len(h)
    largest = n * similar[0] // similar[1]
    out = []
    for level in range(level_of(n), level_of(largest) + 1):
        seed = np.uint64(level * near_dup._PRIME & 0xFFFFFFFFFFFFFFFF)
        rare = int(np.searchsorted(df, FREQUENT, side="right"))
        short = errors + 1 - alone  # signatures that the given tokens still have to promise
        if short <= 0:
            continue
        if rare >= short:
            out.append(near_dup._mix(h[:short] ^ seed))
            continue
        out.append(near_dup._mix(h[:rare] ^ seed))
        frequent = h[rare:]
        n_classes = classes_of(level, similar)
        of = (near_dup._mix(frequent + seed) % np.uint64(n_classes)).astype(np.int64)
        # each token promises one signature more, but for the first of its class
        first = np.zeros(len(frequent), dtype=bool)
        first[np.unique(of, return_index=True)[1]] = True
        promised = np.cumsum(~first)
        end = int(np.searchsorted(promised, short - rare)) + 1
        taken, of = frequent[:end], of[:end]
        order = np.argsort(of, kind="stable")
        taken, of = taken[order], of[order]
        for group in np.split(taken, np.flatnonzero(of[1:] != of[:-1]) + 1):
            i, j = np.triu_indices(len(group), 1)
            low, high = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
            out.append(near_dup._mix(near_dup._mix(low ^ seed) * np.uint64(near_dup._PRIME) + high))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _sign(similar: tuple[int, int]):
    """id, n, shared array<struct<df,h>> by ascending (df, h) -> id, n, typical, sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                lists = b.column("shared")
                flat = lists.flatten()
                df, h = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
                ids, sizes, marks, sigs = [], [], [], []
                for i, n, s, e in zip(b.column("id").to_pylist(), b.column("n").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    found = signatures(n, df[s:e], h[s:e].view(np.uint64), similar)
                    ids.append(np.full(len(found), i))
                    sizes.append(np.full(len(found), n))
                    marks.append(np.full(len(found), np.log(df[s:e]).sum() / n))
                    sigs.append(found.view(np.int64))
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, sizes, marks, sigs)], names=["id", "n", "typical", "sig"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of ids that are similar, by exact intersection."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("tokens").alias(f"tokens_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, ends = {}, {}
            for x in "ab":
                column = b.column(f"tokens_{x}")
                tokens[x] = column.flatten().to_numpy(zero_copy_only=False)
                ends[x] = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
            keep = np.zeros(b.num_rows, dtype=bool)
            for i in range(b.num_rows):
                x, y = (tokens[s][ends[s][i] : ends[s][i + 1]] for s in "ab")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = similar[0] * both >= similar[1] * (len(x) + len(y) - both)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a long, b long")


def _pairs(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def links_between(sets: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """sets (id, n, tokens), all different -> links (a, b) whose components are those of all similar pairs."""
    fits = lambda n, m: F.least(n, m) * similar[0] >= F.greatest(n, m) * similar[1]
    entries = sets.select("id", "n", F.explode("tokens").alias("h"))
    df = entries.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    own = entries.join(df, "h").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("shared"))
    signed = shared.cut(own.mapInArrow(_sign(similar), "id long, n long, typical double, sig long"), "ngram-signed")
    by_sig = signed.groupBy("sig").agg(F.max(F.struct("typical", F.negative("id").alias("id"), "n")).alias("top"), F.count("*").alias("size")).where("size > 1")
    pivots = by_sig.select("sig", (-F.col("top.id")).alias("pivot"), F.col("top.n").alias("pivot_n"), "size")
    members = shared.cut(signed.join(pivots, "sig").select("sig", "id", "n", "pivot", "pivot_n", "size"), "ngram-members")
    shared.forget(signed)
    tried = shared.cut(members.where((F.col("id") != F.col("pivot")) & fits("n", "pivot_n")).select(*_pairs("id", "pivot")).distinct(), "ngram-tried")
    links = shared.cut(verify(tried, sets, similar), "ngram-links")

    labels = shared.components(links).toDF("id", "label")
    named = members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_sigs = named.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("sig")
    named = shared.cut(named.join(open_sigs, "sig"), "ngram-open")
    small = named.where(F.col("size") <= SPLIT).select("sig", "id", "n", "label")
    other = small.select("sig", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("label").alias("label2"))
    pairs = small.join(other, "sig").where((F.col("id") < F.col("id2")) & (F.col("label") != F.col("label2")) & fits("n", "n2")).select(F.col("id").alias("a"), F.col("id2").alias("b"))
    # large buckets around one typical set are one: each member is filed once
    large = named.where((F.col("size") > SPLIT) & (F.col("id") != F.col("pivot"))).select("pivot", "id", "n", "label").distinct()
    if not large.isEmpty():
        filed = shared.cut(_filed(large, sets, similar), "ngram-filed")
        other = filed.select("key", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "label", "slack", "rest")))
        met = filed.join(other, "key").where((F.col("id") < F.col("id2")) & (F.col("label") != F.col("label2")) & fits("n", "n2") & (2 * F.least("rest", "rest2") >= F.col("slack") + F.col("slack2") - 1e-6))
        pairs = pairs.unionAll(met.select(F.col("id").alias("a"), F.col("id2").alias("b")))
    pairs = shared.cut(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "ngram-pairs")
    return shared.cut(links.unionAll(verify(pairs, sets, similar)), "ngram-links")


def _filed(large: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Members of large buckets under the tokens in which they differ from their bucket's typical set.

    With r = (1 - J) / (1 + J) two sets are similar exactly if |x - y| <= r (|x| + |y|), the minus being the symmetric difference. Around
    the typical set p, |x - y| = |x - p| + |y - p| - 2 c, with c the differences that both have; so 2 c >= s + s' with
    slack s = |x - p| - r |x|. Of two sets in different components one is not similar to p, and its slack is over r |p|; no
    slack is under -r |x|, and sizes fit within a factor of J. So each set knows the least c, and files itself under all but so many of its differences, in
    order of hash: a similar pair's last common difference in that order leaves c of them behind.
    """
    t = similar[1] / similar[0]
    r = (1 - t) / (1 + t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                flat, ends = {}, {}
                for x in ("tokens", "pivot_tokens"):
                    flat[x] = b.column(x).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                    ends[x] = np.concatenate([[0], np.cumsum(b.column(x).value_lengths().to_numpy(zero_copy_only=False))])
                out = [[] for _ in range(6)]
                for k, (pivot, i, n, label) in enumerate(zip(*(b.column(c).to_pylist() for c in ("pivot", "id", "n", "label")), strict=True)):
                    own, typical = (flat[x][ends[x][k] : ends[x][k + 1]] for x in ("tokens", "pivot_tokens"))
                    gap = np.setxor1d(own, typical, assume_unique=True)
                    slack = len(gap) - r * n
                    # a far set may meet a near one, whose slack is at least -r times its size; a near set meets only far ones
                    far = slack > r * len(typical)
                    least = (slack - r * n / t if far else slack + r * len(typical)) / 2
                    order = near_dup._mix(gap)
                    order.sort()
                    rest = np.arange(len(order), 0, -1)
                    kept = order[rest >= max(1, least - 1e-6)]
                    keys = near_dup._mix(kept + np.uint64(pivot))
                    for column, x in zip(out, (keys.view(np.int64), np.full(len(kept), i), np.full(len(kept), n), np.full(len(kept), label), np.full(len(kept), slack), rest[: len(kept)]), strict=True):
                        column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["key", "id", "n", "label", "slack", "rest"])

    tokens = sets.select("id", "tokens")
    rows = large.join(tokens, "id").join(tokens.toDF("pivot", "pivot_tokens"), "pivot")
    return rows.select("pivot", "id", "n", "label", "tokens", "pivot_tokens").mapInArrow(run, "key long, id long, n long, label long, slack double, rest long")


def components(documents: DataFrame, words: int = WORDS, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, text) -> one row per row: doc_id, n_shingles, component_id."""
    if similar[1] * 5 < similar[0] * 4:
        raise ValueError("classes of frequent tokens are sized for a similarity of 0.8 or more")
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    sketch = shared.cut(texts.mapInArrow(_sketch(words, similar), "doc_id long, th long, n long, key string, mark long, prefix array<long>"), "ngram-sketch")
    chosen = F.coalesce(F.min_by("th", "doc_id"), F.min("th")).alias("th")
    nodes = shared.cut(sketch.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"), chosen, F.first("n").alias("n"), F.first("mark").alias("mark")), "ngram-nodes")
    # tokens that one set alone sends, by set
    sent = sketch.select("mark", F.explode("prefix").alias("h"))
    alone = sent.groupBy("h").agg(F.min("mark").alias("mark"), F.max("mark").alias("last")).where("mark = last").groupBy("mark").agg(F.count("*").alias("alone"))
    # the same in column expressions: n, the least overlap o and what is then asked of the prefix
    n = F.col("n")
    o = F.expr(f"(n * {similar[1]} + {similar[0] - 1}) div {similar[0]}")
    small = o - F.floor((o * similar[1] + similar[0] - 1) / similar[0]) + 1
    partners = (n > o) | F.expr(f"n * {similar[0]} div {similar[1]} > n")
    left = nodes.where(partners).join(alone, "mark", "left").where(F.least(n, 2 * (n - o) + 1) - F.coalesce("alone", F.lit(0)) >= small)
    left = shared.cut(left.select("key", "th", "least"), "ngram-left")
    shared.free_shuffles(spark)
    wanted = F.broadcast(left) if left.count() <= SENT_ROWS else left
    sets = texts.join(wanted, "th").where("least is null or doc_id = least").select("key", "text").mapInArrow(_sets(words), "key string, n long, tokens array<long>")
    sets = sets.groupBy("key").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    sets = shared.cut(sets.withColumn("id", F.monotonically_increasing_id()), "ngram-sets")
    shared.free_shuffles(spark)
    labels = shared.components(links_between(sets, similar)).toDF("id", "label")
    named = sets.select("id", "key").join(labels, "id").join(nodes.select("key", "least"), "key")
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    moved = named.join(least, "label").select("key", "component")
    found = nodes.join(moved, "key", "left").select("key", F.coalesce("component", "least").alias("component_id"))
    rows = sketch.select("doc_id", F.col("n").alias("n_shingles"), "key")
    whole = rows.where("key is not null").join(found, "key").select("doc_id", "n_shingles", "component_id")
    return whole.unionAll(rows.where("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
